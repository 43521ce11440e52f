"""Releases as a log of versions: published once, promoted by compare-and-swap, restored, and cleared away.

A release's tables lie in a folder of their own. The log has one small file a version, numbered without gaps; a version is current
if no higher one is there. To promote a folder is to create the next file, which only one of several writers can do: the others
lose and find the log as the winner left it. A restore is a version that points to an older folder, so history is never rewritten.
All files are handled by Spark's own file system, so the root may be in any store whose rename fails where the target exists.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .rows import digest


class Conflict(RuntimeError):
    """Another writer promoted a version first."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    digest: str
    #: What it came from: publish, or restore of an older number.
    action: str


class Releases:
    """The releases under a root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def log(self) -> list[Version]:
        """All versions, the oldest first."""
        if not self.fs.exists(self._path("log")):
            return []
        names = sorted(s.getPath().getName() for s in self.fs.listStatus(self._path("log")) if s.getPath().getName().endswith(".json"))
        texts = self.spark.read.text([f"{self.root}/log/{n}" for n in names], wholetext=True).collect() if names else []
        return sorted((Version(**json.loads(r.value)) for r in texts), key=lambda v: v.number)

    def current(self) -> Version | None:
        found = self.log()
        return found[-1] if found else None

    def table(self, name: str, version: Version | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{(version or self.current()).folder}/{name}")

    def _promote(self, version: Version) -> Version:
        """Creates the version's file, whole or not at all; fails if one of that number is there."""
        temp, final = self._path(f"log/.{uuid.uuid4().hex}"), self._path(f"log/{version.number:020d}.json")
        out = self.fs.create(temp, True)
        out.write(bytearray(json.dumps(version.__dict__).encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(temp, final, none)
        except Exception as lost:
            self.fs.delete(temp, False)
            if self.fs.exists(final):
                raise Conflict(f"version {version.number} is there already") from lost
            raise
        return version

    def publish(self, tables: Mapping[str, DataFrame], check: DataFrame | None = None, after: Version | None = None) -> Version:
        """Writes the tables and promotes them after `after` (by default the version that is current at the start).

        Tables equal to those of that version give it back, and nothing is promoted. Rows in `check` (violations) go to quarantine,
        and nothing is promoted either. A writer that lost to another leaves no folder behind.
        """
        before = after or self.current()
        folder = f"data/{uuid.uuid4().hex}"
        try:
            for name, df in tables.items():
                df.write.parquet(f"{self.root}/{folder}/{name}")
            written = {name: self.spark.read.parquet(f"{self.root}/{folder}/{name}") for name in tables}
            said = reduce(DataFrame.unionByName, [digest(df, sorted(df.columns)).select(F.lit(name).alias("name"), "n", "digest") for name, df in written.items()])
            whole = "\n".join(f"{r.name}:{r.n}:{r.digest}" for r in sorted(said.collect()))
            if check is not None and not check.isEmpty():
                check.write.parquet(f"{self.root}/quarantine/{folder.removeprefix('data/')}")
                raise ValueError(f"contract broken; see quarantine/{folder.removeprefix('data/')}")
            if before and before.digest == whole:
                self.fs.delete(self._path(folder), True)
                return before
            return self._promote(Version(before.number + 1 if before else 1, folder, whole, "publish"))
        except BaseException:
            self.fs.delete(self._path(folder), True)
            raise

    def restore(self, number: int | None = None) -> Version:
        """Makes an older version current again: by default that before the current one, as it was when that was promoted."""
        found = self.log()
        by_number = {v.number: v for v in found}
        if not found or (number or found[-1].number - 1) not in by_number:
            raise ValueError("no such version")
        old = by_number[number or found[-1].number - 1]
        if not self.fs.exists(self._path(old.folder)):
            raise ValueError(f"version {old.number} has been cleared away")
        return self._promote(Version(found[-1].number + 1, old.folder, old.digest, f"restore {old.number}"))

    def clear(self, keep: int = 3) -> list[str]:
        """Deletes folders that none of the last `keep` versions points to, and gives their names. The log stays. Folders of writers that aren't done are spared: they are in no version."""
        found = self.log()
        kept = {v.folder for v in found[-keep:]}
        gone = sorted({v.folder for v in found} - kept)
        gone = [f for f in gone if self.fs.exists(self._path(f))]
        for folder in gone:
            self.fs.delete(self._path(folder), True)
        return gone
