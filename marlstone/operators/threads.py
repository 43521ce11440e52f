"""Topic threads: chronological lists of records per recurring entity, and a default topic for each record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .contracts import violations
from .index import label
from .rows import first_per, listed


def topics(members: DataFrame, least: int = 2) -> DataFrame:
    """(entity, label, n, ids) of entities with `least` records or more; members has (entity, id, at). Time, then id, orders a thread."""
    return members.groupBy("entity").agg(F.count("*").alias("n"), listed("id", F.struct("at", "id")).alias("ids")).where(F.col("n") >= least).withColumn("label", label(F.col("entity")))


def default_topic(members: DataFrame, topics_: DataFrame) -> DataFrame:
    """(id, entity): an entity of the title before others (members has in_title), then the narrowest, then by label."""
    known = members.join(topics_.select("entity", "n", "label"), "entity")
    return first_per(known, ["id"], [F.desc("in_title"), "n", F.lower("label"), "entity"]).select("id", "entity")


def match_codes(words: dict[str, Column], alias: Column) -> Column:
    """Letters of the places, in their fixed order, whose padded words hold an alias."""
    return F.array_join(F.filter(F.array(*(F.when(w.contains(alias), F.lit(code)) for code, w in words.items())), lambda x: x.isNotNull()), "")


def follow_ups(members: DataFrame, n_records: int, share: float = 0.07, links: int = 5) -> DataFrame:
    """(src, dst, topics, breadth): later records that share a topic narrow enough (at most `share` of the records), narrowest and then earliest first.

    A record among the first `links` is among the next `links` of its narrowest shared topic, so each record meets only those: an
    equi join on places in the topic, not on the topic.
    """
    narrow = members.groupBy("entity").agg(F.count("*").alias("breadth")).where(F.col("breadth") <= share * n_records)
    m = members.join(narrow, "entity").select("entity", "breadth", "id", "at")
    placed = m.withColumn("place", F.row_number().over(Window.partitionBy("entity").orderBy("at", "id")))
    later = placed.withColumn("after", F.max("place").over(Window.partitionBy("entity", "at")))
    a = later.select("entity", "breadth", F.col("id").alias("src"), F.explode(F.sequence(F.col("after") + 1, F.col("after") + links)).alias("place"))
    b = placed.select("entity", "place", F.col("id").alias("dst"), F.col("at").alias("b_at"))
    near = a.join(b, ["entity", "place"]).groupBy("src", "dst").agg(F.min("breadth").alias("breadth"), F.min("b_at").alias("b_at"))
    best = first_per(near, ["src"], ["breadth", "b_at", "dst"], links)
    both = best.join(m.select(F.col("id").alias("src"), "entity"), "src").join(m.select(F.col("id").alias("dst"), "entity"), ["dst", "entity"])
    return both.groupBy("src", "dst", "breadth").agg(F.array_join(F.sort_array(F.collect_set("entity")), ",").alias("topics"))


def owners(threads_: DataFrame, catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Thread members (url) with the catalogue row of their URL, slashes at the end aside, and violations for those without one."""
    bare = lambda c: F.regexp_replace(F.trim(c), "/+$", "")
    known = catalogue.select(bare(F.col("url")).alias("__u"), F.col("id").alias("owner"))
    both = threads_.join(known, bare(F.col("url")) == F.col("__u"), "left").drop("__u")
    return both.where("owner is not null"), both.where("owner is null").select(F.lit("thread without owner").alias("rule"), F.col("url").alias("key"))


def invariants(topics_: DataFrame, members: DataFrame, least: int = 2) -> DataFrame:
    """(rule, key) of topics (entity, n, ids) that break a rule: enough records, as many as said, none twice, in order of time, none missing or foreign. members has (entity, id, at)."""
    each = topics_.select("entity", F.posexplode("ids").alias("place", "id")).join(members.select("entity", "id", "at"), ["entity", "id"], "full_outer")
    w = Window.partitionBy("entity").orderBy("place")
    late = each.where("place is not null").withColumn("before", F.lag("at").over(w)).where("before > at").select(F.lit("order").alias("rule"), F.col("entity").alias("key"))
    wide = members.groupBy("entity").agg(F.count("*").alias("k")).where(F.col("k") >= least).select("entity")
    missing = each.where("place is null").join(wide, "entity", "left_semi").select(F.lit("missing member").alias("rule"), F.col("entity").alias("key"))
    foreign = each.where("at is null").select(F.lit("foreign member").alias("rule"), F.col("entity").alias("key"))
    own = violations(topics_, F.col("entity"), {"enough records": F.col("n") >= least, "count": F.col("n") == F.size("ids"), "no repeats": F.size(F.array_distinct("ids")) == F.size("ids")})
    return own.unionByName(late).unionByName(missing).unionByName(foreign).distinct()
