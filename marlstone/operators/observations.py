"""Observations: passages of posts that describe a trade, with fields drawn from the passage alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import observe as O
from ..functions import text as X
from ..functions.text_udf import normalize_identity
from ..session import dealt, stored
from .rows import dedup_by_prefix, first_per

#: Least length of a body, and most windows taken where no paragraph speaks of a trade.
LEAST_BODY, MOST_WINDOWS = 200, 5


def passages(posts: DataFrame, separator: str = "\n\n") -> DataFrame:
    """Eligible paragraphs of bodies that are long enough: url, pos, passage."""
    body = posts.where(F.length("body_text") >= LEAST_BODY)
    parts = body.select("url", "title", "post_date", F.posexplode(X.paragraphs(F.col("body_text"), separator)).alias("pos", "whole"))
    return parts.where(~O.is_reference_only("whole"))


def fields(df: DataFrame) -> DataFrame:
    """The structured fields of the column trade_description with its reading; the title only helps to name a fund."""
    d = F.col("trade_description")
    return df.select(
        F.col("title").alias("article_title"), F.col("url").alias("article_url"), F.substring("post_date", 1, 10).alias("article_date"), d,
        O.instruments(d).alias("instruments"), F.col("said.direction").alias("direction"), O.underlying(d).alias("underlying"), O.thesis(d).alias("edge_or_thesis"), O.quantities(d).alias("any_quant_detail"),
        O.outcome(d).alias("outcome_if_mentioned"), F.coalesce(O.fund(d), O.fund(F.col("title"))).alias("fund_name_if_mentioned"), (F.length(d) < F.length("whole")).alias("description_truncated"), "pos",
    )


def extract(posts: DataFrame) -> DataFrame:
    """Observations of posts: trade paragraphs, or sentence windows where a post has none; one for each start of a passage."""
    read = lambda df: df.withColumn("trade_description", X.excerpt(F.col("whole"))).withColumn("said", O.reading("trade_description"))
    parts = stored(read(passages(posts)), "passages")
    found = parts.where("said.trade_block")
    rest = parts.join(found.select("url").distinct(), "url", "left_anti")
    text = dealt(rest, "url").groupBy("url").agg(F.first("title").alias("title"), F.first("post_date").alias("post_date"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "whole"))), lambda p: p.whole), "\n\n").alias("text"))
    spans = text.select("url", "title", "post_date", F.posexplode(F.slice(O.sentence_windows(X.sentences(F.col("text"))), 1, MOST_WINDOWS)).alias("pos", "whole"))
    fallback = read(spans).where("said.trade_block").where(F.length("trade_description") > 50)
    every = dealt(found.select(*fallback.columns).unionByName(fallback), "url")
    return fields(first_per(every, ["url", F.substring("trade_description", 1, 100)], ["pos"]))


def published(observations: DataFrame) -> DataFrame:
    """Observations without false positives and repeats, underlyings cleaned."""
    d = F.col("trade_description")
    real = observations.where(~O.false_positive(d, F.col("direction"), F.col("instruments")))
    return dedup_by_prefix(real, "article_url", "trade_description", 150, "pos").withColumn("underlying", O.clean_underlying(F.col("underlying")))


def documentation(observations: DataFrame) -> DataFrame:
    """How much of a trade an observation documents: the fields that are there, their number, and warnings."""
    have = {"underlying": "underlying", "thesis": "edge_or_thesis", "quantity": "any_quant_detail", "outcome": "outcome_if_mentioned", "manager": "fund_name_if_mentioned"}
    flags = F.filter(F.array(*(F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.lit(n)) for n, c in have.items())), lambda x: x.isNotNull())
    d = F.col("trade_description")
    return observations.withColumns({"documentation_fields": flags, "documentation_score": F.size(flags), "reference_line": O.is_reference_only(d), "negation_risk": O.negation_risk(d)})


def resolve_directions(observations: DataFrame, cache: DataFrame) -> DataFrame:
    """Unspecified directions filled from a table of labels by the passage's digest; denied and reference passages stay."""
    d = F.col("trade_description")
    known = cache.select(F.col("digest").alias("__d"), F.col("label").alias("__l"))
    keyed = observations.join(known, F.sha2(d, 256) == F.col("__d"), "left")
    open_ = (F.col("direction") == "unspecified") & F.col("__l").isNotNull()
    read = keyed.withColumn("__said", O.reading(F.when(open_, d)))  # only what a label could fill is read
    fits = open_ & ~F.col("__said.negation_risk") & ~F.col("__said.reference_only")
    return read.withColumn("direction", F.when(fits, F.col("__l")).otherwise(F.col("direction"))).drop("__d", "__l", "__said")


# Aliases of managers by their identity text, and the label of each (fixed values).
MANAGERS = {
    "citadel": "Citadel / Ken Griffin", "griffin / citadel": "Citadel / Ken Griffin", "griffin": "Citadel / Ken Griffin",
    "bridgewater": "Bridgewater / Ray Dalio", "dalio / bridgewater": "Bridgewater / Ray Dalio", "dalio": "Bridgewater / Ray Dalio",
    "ackman": "Pershing Square / Bill Ackman", "ackman / pershing": "Pershing Square / Bill Ackman",
    "druckenmiller": "Duquesne / Stanley Druckenmiller", "duquesne": "Duquesne / Stanley Druckenmiller",
    "point72": "Point72 / Steve Cohen", "cohen / point72": "Point72 / Steve Cohen",
    "tiger": "Tiger Management / Julian Robertson", "robertson / tiger": "Tiger Management / Julian Robertson",
    "third point": "Third Point / Dan Loeb", "loeb / third point": "Third Point / Dan Loeb",
    "brevan howard": "Brevan Howard / Alan Howard", "howard": "Brevan Howard / Alan Howard",
    "einhorn / greenlight": "Greenlight / David Einhorn", "einhorn": "Greenlight / David Einhorn",
}


def managers(observations: DataFrame, name: str, labels: dict[str, str] = MANAGERS) -> DataFrame:
    """observations with manager_raw (white space tidied), manager (the label of a known alias) and manager_key."""
    raw = X.strip(F.regexp_replace(F.coalesce(name, F.lit("")), "(?U)\\s+", " "))
    fixed = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    named = observations.withColumn("manager_raw", raw).withColumn("manager", F.coalesce(F.try_element_at(fixed, normalize_identity("manager_raw")), F.col("manager_raw")))
    return named.withColumn("manager_key", normalize_identity("manager"))


def split_values(c: Column) -> Column:
    """The parts of a list in one text: cut at semicolons, trimmed, dashes left out."""
    return F.filter(F.split(c, "\\s*;\\s*"), lambda v: ~X.strip(v).isin("", "—", "-"))


def rollup(observations: DataFrame, key: str) -> DataFrame:
    """One row per article: number of observations, sorted sets of directions, instruments and managers, the first spelling of each underlying, and what any observation has."""
    some = lambda c: F.bool_or(F.coalesce(F.col(c), F.lit("")) != "")
    one = observations.groupBy(key).agg(
        F.count("*").alias("n"), F.sort_array(F.collect_set("direction")).alias("directions"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("instruments")))).alias("instruments"),
        F.sort_array(F.collect_set(F.nullif(F.col("manager"), F.lit("")))).alias("managers"), some("any_quant_detail").alias("has_quant"), some("edge_or_thesis").alias("has_thesis"), some("outcome_if_mentioned").alias("has_outcome"),
    )
    each = observations.select(key, "pos", F.posexplode(split_values(F.coalesce("underlying", F.lit("")))).alias("at", "v")).withColumn("k", normalize_identity("v"))
    first = each.groupBy(key, "k").agg(F.min_by("v", F.struct("pos", "at")).alias("v"))
    under = first.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct(F.lower("v").alias("o"), "v"))), lambda x: x.v).alias("underlyings"))
    return one.join(under, key, "left").withColumn("underlyings", F.coalesce("underlyings", F.array().cast("array<string>")))
