"""Findings that time raises by itself: a source that was degraded and then fell silent is reported once its streak is old enough.

State per source, with an event-time timer at the streak's first check plus the hours that make it persistent. A healthy check
clears the timer; when the watermark passes it a finding goes out, though no
check of that source came any more. Needs Spark's RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.health import PERSISTENT_HOURS

FINDING = "source string, since timestamp, n long, raised_at timestamp"


class _Silence(StatefulProcessor):
    def __init__(self, hours: int):
        self.span = hours * 3_600_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.streak = handle.getValueState("streak", "since long, n long, timer long, raised boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        since, n, timer, raised = self.streak.get() if self.streak.exists() else (-1, 0, -1, False)
        checks = pd.concat(list(rows)).sort_values("checked_at")
        times = checks["checked_at"].astype("datetime64[us]").astype("int64") // 1000
        for at, status in zip(times.tolist(), checks["status"].tolist()):
            if status == "ok":
                since, n, raised = -1, 0, False
            else:
                since, n = (at, 1) if n == 0 else (since, n + 1)
        if timer >= 0 and timer != since + self.span:
            self.handle.deleteTimer(timer)
            timer = -1
        if n and not raised and timer < 0:
            timer = since + self.span
            self.handle.registerTimer(timer)
        self.streak.update((since, n, timer, raised))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        since, n, _, _ = self.streak.get()
        self.streak.update((since, n, -1, True))
        at = expiredTimerInfo.getExpiryTimeInMs()
        yield pd.DataFrame({"source": [key[0]], "since": [pd.Timestamp(since, unit="ms")], "n": [n], "raised_at": [pd.Timestamp(at, unit="ms")]})

    def close(self) -> None:
        pass


def findings(checks: DataFrame, hours: int = PERSISTENT_HOURS, lateness: str = "0 seconds") -> DataFrame:
    """(source, since, n, raised_at) for a stream of (source, checked_at, status), once for each streak that gets `hours` old."""
    timed = checks.withWatermark("checked_at", lateness)
    return timed.groupBy("source").transformWithStateInPandas(_Silence(hours), FINDING, "Append", "EventTime")
