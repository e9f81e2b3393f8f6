"""Counts against the hours before them, kept as state of a stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "series STRING, event_hour TIMESTAMP, event_count BIGINT, sum_before BIGINT, hours_before BIGINT"


class CountsBefore(StatefulProcessor):
    """For every finished hour of a series, the sum and number of the hours with events before it.

    State is the last ``before`` counts of a series, whatever the number of events. A timer in event time drops a
    series that had no events for ``idle_hours``. Hours of a series arrive in order: an hour is given out once the watermark has
    passed it, and hours given out together are sorted here.
    """

    def __init__(self, before: int, idle_hours: int):
        self.before, self.idle_hours = before, idle_hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "event_count BIGINT")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        hours = pd.concat(list(rows)).sort_values("event_hour")
        counts = [row[0] for row in self.recent.get()] if self.recent.exists() else []
        sums, numbers = [], []
        for count in hours["event_count"]:
            sums.append(sum(counts) if counts else None)
            numbers.append(len(counts))
            counts = [*counts, int(count)][-self.before :]
        self.recent.put([(count,) for count in counts])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        last = int(hours["event_hour"].iloc[-1].timestamp() * 1000)
        self.handle.registerTimer(last + self.idle_hours * 3_600_000)
        yield pd.DataFrame(
            {
                "series": key[0],
                "event_hour": hours["event_hour"].to_numpy(),
                "event_count": hours["event_count"].to_numpy(),
                "sum_before": pd.array(sums, dtype="Int64"),
                "hours_before": numbers,
            }
        )

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.recent.clear()
        return iter([])

    def close(self) -> None:
        pass
