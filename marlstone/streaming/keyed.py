"""A keyed store that grows by batches: increments that are merged when read and compacted now and then, and a cache of labels on it.

Each batch is one folder named by its number, so a batch that is run again after a failure overwrites itself. A compaction writes
one base from all increments up to a number and then deletes them; a reader takes the newest complete base and what came after it,
so it finds the same rows before, during and after.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyedStore:
    """Rows by key under a path; a later batch's row replaces an earlier one's."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], compact_every: int = 10):
        self.spark, self.path, self.schema, self.keys, self.compact_every = spark, path.rstrip("/"), schema, list(keys), compact_every
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind: base or batch."""
        if not self.fs.exists(self._path("")):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self._path(""))]
        found = [int(n.split("-")[1]) for n in names if n.startswith(kind + "-")]
        return sorted(n for n in found if self.fs.exists(self._path(f"{kind}-{n}/_SUCCESS")))

    def read(self) -> DataFrame:
        """The newest row of each key."""
        base = max(self._numbers("base"), default=-1)
        folders = ([(base, f"base-{base}")] if base >= 0 else []) + [(n, f"batch-{n}") for n in self._numbers("batch") if n > base]
        out = self.spark.createDataFrame([], self.schema)
        columns = out.columns
        every = out.withColumn("__batch", F.lit(0))
        for n, folder in folders:
            every = every.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}").withColumn("__batch", F.lit(n)))
        rest = [c for c in columns if c not in self.keys]
        newest = every.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "__batch").alias("__row"))
        return newest.select(*self.keys, *(F.col(f"__row.{c}").alias(c) for c in rest)).select(*columns)

    def put(self, batch: DataFrame, number: int) -> None:
        """Adds a batch, one row a key, under its number; for foreachBatch. A number that is compacted already is not written again."""
        base = max(self._numbers("base"), default=-1)
        if number <= base:
            return
        batch.select(*self.spark.createDataFrame([], self.schema).columns).dropDuplicates(self.keys).write.mode("overwrite").parquet(f"{self.path}/batch-{number}")
        if len([n for n in self._numbers("batch") if n > base]) >= self.compact_every:
            self.compact()

    def compact(self) -> None:
        done = self._numbers("batch")
        if not done:
            return
        old = self._numbers("base")
        if done[-1] > max(old, default=-1):
            self.read().write.mode("overwrite").parquet(f"{self.path}/base-{done[-1]}")
        for n in done:
            self.fs.delete(self._path(f"batch-{n}"), True)
        for n in (n for n in old if n < done[-1]):
            self.fs.delete(self._path(f"base-{n}"), True)

    def next_number(self) -> int:
        return max([*self._numbers("base"), *self._numbers("batch")], default=-1) + 1


LABELS = "digest string, label string, asked_at string"


def label_store(spark: SparkSession, path: str, compact_every: int = 10) -> KeyedStore:
    return KeyedStore(spark, path, LABELS, ["digest"], compact_every)


def labelled(passages: DataFrame, store: KeyedStore, ask: Callable[[DataFrame], DataFrame], now: str, number: int | None = None) -> DataFrame:
    """passages (digest, text) with label: from the store, or from ask where the store has no answer.

    Each text is asked for once, however often it stands there. ask gets (digest, text) and gives (digest, label): a null label is an
    abstention and is kept, so it isn't asked for again; a text it gives no row for met an outage, and is asked for the next time.
    """
    wanted = passages.groupBy("digest").agg(F.first("text").alias("text")).join(store.read().select("digest"), "digest", "left_anti")
    answers = ask(wanted).select("digest", "label", F.lit(now).alias("asked_at"))
    store.put(answers, store.next_number() if number is None else number)
    return passages.join(store.read().select("digest", "label"), "digest", "left")
