"""Degradation streaks over a stream of checks, with state per source."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.rows import upsert

OUT = "source string, checked_at timestamp, status string, since timestamp, n long"
STATE = "since timestamp, n long"


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    since, n = state.get if state.exists else (None, 0)
    rows = pd.concat(list(batches)).sort_values("checked_at")
    out = []
    for at, status in zip(rows["checked_at"], rows["status"]):
        bad = status != "ok"
        since, n = (since if n else at, n + 1) if bad else (None, 0)
        out.append((key[0], at, status, since, n))
    state.update((since, n))
    yield pd.DataFrame(out, columns=["source", "checked_at", "status", "since", "n"])


def streaks(checks: DataFrame) -> DataFrame:
    """(source, checked_at, status, since, n) for a stream of (source, checked_at, status); checks of a source must come in order of time."""
    return checks.groupBy("source").applyInPandasWithState(_advance, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def merged_window(path: str, keys: list[str]):
    """A foreachBatch function that upserts each batch into versions of a table: path/v=<batch>. The newest version is the state; a batch that is run again overwrites its own version."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = batch if number == 0 else upsert(spark.read.parquet(f"{path}/v={number - 1}"), batch, keys)
        state.write.mode("overwrite").parquet(f"{path}/v={number}")

    return run
