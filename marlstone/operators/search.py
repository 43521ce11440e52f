"""Tiered literal search over observations."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import coded, stored
from .rows import Down, numbered, pairs_of_classes

TIERS = ("exact", "subject", "related", "mention")


def query_tokens(query: str) -> list[str]:
    return re.findall(r"[a-z0-9&.%-]+", query.lower())


def holds(text: Column, tokens: Sequence[str]) -> Column:
    """All tokens are in a text; those of up to three characters as whole words."""
    low = F.lower(F.coalesce(text, F.lit("")))
    words = F.split(low, "[^a-z0-9&.%-]+")
    found = F.lit(bool(tokens))
    for t in tokens:
        found = found & (F.array_contains(words, t) if len(t) <= 3 else low.contains(t))
    return found


def tiered(rows: DataFrame, query: str, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """rows that match, with tier (number and name) and part: the best tier found is primary, lower ones related; a mention alone is never primary.

    fields maps tiers to columns. The best tier is one number, found by an aggregate and joined back.
    """
    tokens = query_tokens(query)
    tier = F.coalesce(*(F.when(holds(F.concat_ws(" ", *fields[t]), tokens), F.lit(i)) for i, t in enumerate(TIERS) if fields.get(t)))
    hits = rows.withColumn("tier_no", tier).where("tier_no is not null")
    best = hits.agg(F.min("tier_no").alias("__best"))
    part = F.when((F.col("tier_no") == F.col("__best")) & (F.col("tier_no") < len(TIERS) - 1), "primary").otherwise("related")
    name = F.element_at(F.array(*map(F.lit, TIERS)), F.col("tier_no") + 1)
    return hits.join(F.broadcast(best), F.lit(True)).withColumns({"part": part, "tier": name}).drop("__best")


def refined(rows: DataFrame, any_of: Mapping[str, Sequence[str]], equal: Mapping[str, str], since: str | None = None, until: str | None = None, day: str = "date") -> DataFrame:
    """Hard filters: any of a facet's values, equal values, a period; the applied ones are listed in reasons. Without any filter nothing is left."""
    reasons = []
    for c, values in any_of.items():
        if values:
            rows = rows.where(F.arrays_overlap(F.col(c), F.array(*map(F.lit, values))))
            reasons.append(f"{c}: {', '.join(values)}")
    for c, value in equal.items():
        rows = rows.where(F.col(c) == value)
        reasons.append(f"{c}: {value}")
    if since or until:
        rows = rows.where((F.col(day) >= (since or "")) & (F.col(day) <= (until or "9999")))
        reasons.append(f"period: {since or ''}..{until or ''}")
    return rows.where(F.lit(bool(reasons))).withColumn("reasons", F.array(*map(F.lit, reasons)).cast("array<string>"))


def note_tallies(rows: DataFrame, note: str, values: str) -> DataFrame:
    """(value, notes, passages) of a list column: in how many notes each value stands, not only in how many passages."""
    each = rows.select(note, F.explode(F.array_distinct(values)).alias("value"))
    return each.groupBy("value").agg(F.count_distinct(note).alias("notes"), F.count("*").alias("passages"))


def note_summary(rows: DataFrame, note: str) -> DataFrame:
    """One row: passages and notes, and notes with quantities and outcomes."""
    some = lambda c: F.count_distinct(F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(note)))
    return rows.agg(F.count("*").alias("passages"), F.count_distinct(note).alias("notes"), some("quant").alias("notes_with_quant"), some("outcome").alias("notes_with_outcome"))


def facets(rows: DataFrame, key: str, label: Column, passage: str, note: str) -> DataFrame:
    """(label, passages, notes) by normalised key, each counted once in a passage; ordered by notes, passages, label."""
    first = Window.partitionBy("k").orderBy(passage, "l")
    one = rows.select(F.col(passage), F.col(note), F.col(key).alias("k"), label.alias("l")).groupBy(passage, note, "k").agg(F.min("l").alias("l"))
    named = one.withColumn("label", F.first("l").over(first))
    return named.groupBy("k").agg(F.min("label").alias("label"), F.count("*").alias("passages"), F.count_distinct(note).alias("notes")).orderBy(F.desc("notes"), F.desc("passages"), "label")


def checkpoint_status(date: Column, checked: Column) -> Column:
    return F.when(date < checked, "overdue").otherwise("upcoming")


def framed(rows: DataFrame, query: str, fields: Mapping[str, Sequence[str]], question: str = "") -> DataFrame:
    """Tiered hits with the reader's framing question beside them; the question never changes what is found."""
    return tiered(rows, query, fields).withColumn("question", F.lit(question))


def annotated(ordered: DataFrame, context: DataFrame, day: str = "date") -> DataFrame:
    """Hits with the macro reading of their day, added after they are ranked: none goes, none moves."""
    return ordered.join(context.withColumnRenamed("day", day), day, "left")


def queue(rows: DataFrame, retained: DataFrame, key: str, fields: Sequence[str], order: str, **equal: str) -> DataFrame:
    """A saved queue's rows, filtered and sorted by the values it retained when they were saved, whatever the current rows say now; what the row says now comes as now_*."""
    now = rows.select(F.col(key), *(F.col(f).alias(f"now_{f}") for f in fields), F.lit(True).alias("__here"))
    kept = retained.join(now, key, "left").withColumn("still_there", F.coalesce("__here", F.lit(False))).drop("__here")
    for c, value in equal.items():
        kept = kept.where(F.col(c) == value)
    return numbered(kept, [Down(order), key], "place").withColumn("place", (F.col("place") + 1).cast("int"))


def page(rows: DataFrame, order: Sequence[Column], size: int, pinned: Column) -> DataFrame:
    """The first `size` rows in an order, and pinned rows wherever they stand."""
    first = rows.orderBy(*order).limit(size)
    return first.unionByName(rows.where(F.coalesce(pinned, F.lit(False)))).distinct()


def by_field(rows: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(src, dst, why): rows that share an exact value of a qualifying field, each with the fields they share. Rows with the same values form a class; what classes share is found once, and pairs of rows are made from it, dealt evenly."""
    value = lambda f: F.lower(F.trim(F.col(f)))
    values = F.array(*(F.when(value(f) != "", F.struct(F.lit(f).alias("field"), value(f).alias("v"))) for f in fields))
    # a key's rows taken together, as a key may have several
    own = rows.select(F.col(key).alias("id"), F.explode(F.filter(values, lambda x: x.isNotNull())).alias("x")).groupBy("id").agg(F.sort_array(F.collect_set("x")).alias("xs"))
    own = stored(own, "values")
    classes = coded(own.select("xs").distinct(), "classes").withColumnRenamed("no", "class")
    members = stored(own.join(classes, "xs").select("id", "class"), "members")
    each = stored(classes.select("class", F.explode("xs").alias("x")).select("class", "x.*"), "each")
    both = each.withColumnRenamed("class", "a").join(each.select(F.col("class").alias("b"), "field", "v"), ["field", "v"])
    links = both.groupBy("a", "b").agg(F.sort_array(F.collect_set("field")).alias("why"))
    return pairs_of_classes(members, links)
