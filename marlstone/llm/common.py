"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Java and RE2 pattern of the white space that separates words; bytes.split() uses the same six characters.
SPACE = "[\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder, read by Spark only (the folder may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, wish: str) -> str:
    """wish, or wish with underscores behind it until no column of df has that name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; None has none. Only the six ASCII spaces separate."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share. Where it is unset, a fresh local one, but only in local mode: executors on other machines don't see it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="marlstone-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, tag: str) -> DataFrame:
    """df cut from its lineage: written as Parquet to the shared folder and read back, so that lost executors cost no rerun."""
    return Scratch(df.sparkSession).write(df, tag)


class Scratch:
    """States of one run in the shared folder; a state is deleted once its successor is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held = spark, []

    def _path(self, tag: str) -> str:
        return f"{shared_dir(self.spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        path = self._path(tag)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def deal(self, df: DataFrame, tag: str, key: str) -> DataFrame:
        """df dealt by a key once: later joins on the key read it as it lies and shuffle only their other side."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path, name = self._path(tag), f"marlstone_{uuid.uuid4().hex}"
        df.repartition(n, col(key)).write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, key).sortBy(key).saveAsTable(name)
        out = self.spark.table(name)
        out.schema  # noqa: B018  resolved before the name goes; the files stay
        self.spark.sql(f"DROP TABLE {name}")
        self.held.append((out, path))
        return out

    def drop(self, *states: DataFrame | None) -> None:
        """Deletes states that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for path in [p for df, p in self.held if any(df is s for s in states)]:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        self.held = [(df, p) for df, p in self.held if not any(df is s for s in states)]


#: Rows that Python holds as objects at once.
ROWS = 512


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ROWS rows: texts and lists take several times their Arrow size as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)
    release()


def release() -> None:
    """Gives memory that a task has freed back to the system: workers idle beside those of the next stage."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


try:
    _TRIM = ctypes.CDLL(None).malloc_trim  # of glibc
except (AttributeError, OSError, TypeError):
    _TRIM = None


def with_struct(df: DataFrame, name: str, inputs: list[Column], fn: Callable[..., list[list]], schema: T.StructType) -> DataFrame:
    """df with one more struct column, computed batch by batch: fn gets a list of values for each input and gives a list for each field.

    All columns of df pass through as Arrow arrays, untouched.
    """
    given = free_name(df, "__given")
    out = T.StructType([*df.schema.fields, T.StructField(name, schema, True)])
    fields = [pa.field(f.name, to_arrow_type(f.dataType), f.nullable) for f in schema.fields]
    n = len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            last = batch.column(batch.num_columns - 1)
            got = fn(*[last.field(i).to_pylist() for i in range(n)])
            made = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(got, fields, strict=True)], fields=fields)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*batch.schema.names[:-1], name])

    fed = df.select(*[col(c) for c in df.columns], F.struct(*[c.alias(f"c{i}") for i, c in enumerate(inputs)]).alias(given))
    return fed.mapInArrow(run, out)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: a lambda variable can't be inlined by the optimizer."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
