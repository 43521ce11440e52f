"""A writer of canonical JSON: tables as ordered lines with sorted keys, bounded in bytes, all of them or none.

Each task writes one part under a staging folder and reports its name, size and digest. When all tasks are done the parts that
were reported get their places by order, with a manifest beside them, and the folder gets its final name in one step; where a task
or a bound fails, the staging folder goes and nothing else was touched. Parts of lost or repeated attempts were never reported and
go with the staging folder. Paths are read by pyarrow's file systems, so they may be in any store these know.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Part(WriterCommitMessage):
    place: int
    name: str
    lines: int
    size: int
    sha256: str


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.most = options["path"].rstrip("/"), int(options.get("mostbytes", "0"))
        self.staging = f"{self.path}.staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        store, staging = _store(self.staging)
        store.create_dir(staging, recursive=True)
        name = uuid.uuid4().hex
        digest, lines, size = hashlib.sha256(), 0, 0
        with store.open_output_stream(f"{staging}/{name}") as out:
            for batch in iterator:
                for line in batch.column(0).to_pylist():
                    raw = line.encode() + b"\n"
                    size += len(raw)
                    if self.most and size > self.most:
                        raise ValueError(f"more than {self.most} bytes")
                    digest.update(raw)
                    out.write(raw)
                    lines += 1
        return Part(TaskContext.get().partitionId(), name, lines, size, digest.hexdigest())

    def commit(self, messages: list[Part | None]) -> None:
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.place)
        if self.most and sum(p.size for p in parts) > self.most:
            self.abort(messages)
            raise ValueError(f"{sum(p.size for p in parts)} bytes in all, more than {self.most}")
        store, staging = _store(self.staging)
        _, final = _store(self.path)
        store.create_dir(f"{staging}/final", recursive=True)
        rows = []
        for p in (p for p in parts if p.lines):
            store.move(f"{staging}/{p.name}", f"{staging}/final/part-{len(rows):05d}.json")
            rows.append({"lines": p.lines, "sha256": p.sha256, "size": p.size})
        with store.open_output_stream(f"{staging}/final/_manifest") as out:
            out.write(json.dumps({"lines": sum(r["lines"] for r in rows), "parts": rows, "size": sum(r["size"] for r in rows)}, sort_keys=True, separators=(",", ":")).encode())
        if store.get_file_info(final).type != pafs.FileType.NotFound:
            store.delete_dir(staging)
            raise ValueError(f"{self.path} is there already")
        store.move(f"{staging}/final", final)
        store.delete_dir(staging)

    def abort(self, messages: list[Part | None]) -> None:
        store, staging = _store(self.staging)
        if store.get_file_info(staging).type != pafs.FileType.NotFound:
            store.delete_dir(staging)


class JsonLines(DataSource):
    """format("canonical_json"): one text column of lines, written with the options path and mostBytes."""

    @classmethod
    def name(cls) -> str:
        return "canonical_json"

    def schema(self) -> str:
        return "line string"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options))


def canonical(df: DataFrame) -> DataFrame:
    """(line) of each row: its fields in order of their names, nulls too."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("line"))


def write(df: DataFrame, path: str, order: list[str], most_bytes: int = 0) -> None:
    """df as canonical JSON lines in a total order, all parts or none; more than most_bytes (0: any number) is refused."""
    df.sparkSession.dataSource.register(JsonLines)
    lines = canonical(df.repartitionByRange(*order).sortWithinPartitions(*order))
    lines.write.format("canonical_json").mode("append").option("path", path).option("mostBytes", str(most_bytes)).save()


def read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(f"{path}/part-*.json")
