"""Tiered literal search over a stored index: the same hits as search.tiered, without reading the rows that are searched.

Words of each tier's fields have posting lists in chunks of 65,536 keys, as 16-bit places in order. Lists are dealt into folders by
a hash of the word and sorted by it, so that a search reads the folders and pages of its own words alone. A token of up to three
characters is one word; a longer one is looked up in the vocabulary, which is as small as the language, and stands for all words
that contain it. Lists are intersected chunk by chunk, those of the rarest token first, and only what is left becomes keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .search import TIERS, query_tokens

BUCKETS, CHUNK = 64, 1 << 16


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def build(rows: DataFrame, key: str, fields: Mapping[str, Sequence[str]], path: str) -> None:
    """Writes the index of rows (key: an integer that isn't negative): postings by word, and the vocabulary."""
    words = lambda names: F.array_distinct(F.split(F.lower(F.concat_ws(" ", *names)), "[^a-z0-9&.%-]+"))
    tiers = F.array(*(F.struct(F.lit(i).alias("tier_no"), words(fields[t]).alias("words")) for i, t in enumerate(TIERS) if fields.get(t)))
    each = rows.select(F.col(key).cast("long").alias("key"), F.explode(tiers).alias("t")).select("key", "t.tier_no", F.explode("t.words").alias("word")).where("word <> ''")
    lists = each.groupBy("word", "tier_no", F.floor(F.col("key") / CHUNK).alias("chunk")).agg(F.sort_array(F.collect_set((F.col("key") % CHUNK).cast("int"))).alias("places"))
    dealt = lists.withColumn("bucket", _bucket(F.col("word"))).repartition("bucket").sortWithinPartitions("bucket", "word")
    dealt.write.partitionBy("bucket").parquet(f"{path}/postings")
    stored = rows.sparkSession.read.parquet(f"{path}/postings")
    stored.groupBy("bucket", "word").agg(F.sum(F.size("places")).alias("df")).repartition("bucket").write.parquet(f"{path}/words")


def _words_of(spark: SparkSession, path: str, token: str) -> DataFrame:
    words = spark.read.parquet(f"{path}/words")
    return words.where(F.col("word") == token) if len(token) <= 3 else words.where(F.col("word").contains(token))


def lists_of(spark: SparkSession, path: str, token: str) -> DataFrame:
    """(tier_no, chunk, places) of all words that a token stands for."""
    postings = spark.read.parquet(f"{path}/postings")
    if len(token) <= 3:
        own = postings.where((F.col("bucket") == _bucket(F.lit(token))) & (F.col("word") == token))
        return own.select("tier_no", "chunk", "places")
    own = postings.join(_words_of(spark, path, token).select("bucket", "word"), ["bucket", "word"], "left_semi")
    return own.groupBy("tier_no", "chunk").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))


def find(spark: SparkSession, path: str, query: str) -> DataFrame:
    """(key, tier_no, tier, part) of rows that hold all tokens of the query in a tier's fields: the first such tier of each; the best tier found is primary, a mention never."""
    tokens = list(dict.fromkeys(query_tokens(query)))
    if not tokens:
        return spark.createDataFrame([], "key long, tier_no int, tier string, part string")
    sizes = {t: _words_of(spark, path, t).agg(F.sum("df").alias("df")).first().df or 0 for t in tokens}
    lists = [lists_of(spark, path, t) for t in sorted(tokens, key=lambda t: (sizes[t], t))]

    def both(a: DataFrame, b: DataFrame) -> DataFrame:
        met = a.join(b.withColumnRenamed("places", "more"), ["tier_no", "chunk"])
        return met.select("tier_no", "chunk", F.array_intersect("places", "more").alias("places")).where(F.size("places") > 0)

    keys = reduce(both, lists).select("tier_no", F.explode(F.transform("places", lambda p: F.col("chunk") * CHUNK + p)).alias("key"))
    hits = keys.groupBy("key").agg(F.min("tier_no").alias("tier_no"))
    best = hits.agg(F.min("tier_no").alias("best"))
    part = F.when((F.col("tier_no") == F.col("best")) & (F.col("tier_no") < len(TIERS) - 1), "primary").otherwise("related")
    name = F.element_at(F.array(*map(F.lit, TIERS)), F.col("tier_no") + 1)
    return hits.join(F.broadcast(best), F.lit(True)).select("key", "tier_no", name.alias("tier"), part.alias("part"))
