"""Counts of outcomes while they are written, without a second pass over them."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

STATUSES = {"processed": "done", "skipped": "skipped", "errors": "error"}


def _counts(status: str) -> list:
    return [F.count_if(F.col(status) == value).alias(name) for name, value in STATUSES.items()]


class Tally:
    """Outcome counts of batch writes, by name: a write of the same name replaces the earlier one's counts."""

    def __init__(self, status: str = "status"):
        self._status, self._seen = status, {}

    def watch(self, rows: DataFrame, name: str = "") -> DataFrame:
        """The rows, to be written once; their counts are known when the write has ended."""
        self._seen[name] = Observation()
        return rows.observe(self._seen[name], *_counts(self._status))

    def counts(self) -> dict[str, int]:
        """Sums over all watched writes; waits for those that are going on."""
        found = [o.get for o in list(self._seen.values())]
        return {name: sum(f[name] for f in found) for name in STATUSES}


class StreamTally(StreamingQueryListener):
    """Outcome counts of a stream, micro-batch by micro-batch as it goes; a repeated micro-batch replaces its counts.

    ``watch`` the stream, add the tally to ``spark.streams`` before the query starts, read ``counts`` at any time; after ``ended`` they are whole.
    """

    def __init__(self, name: str = "outcomes", status: str = "status"):
        self._name, self._status, self._seen, self._ended = name, status, {}, threading.Event()

    def watch(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self._name, *_counts(self._status))

    def counts(self) -> dict[str, int]:
        return {name: sum(c[name] for c in list(self._seen.values())) for name in STATUSES}

    def ended(self, seconds: float = 60) -> bool:
        return self._ended.wait(seconds)

    def onQueryStarted(self, event) -> None:
        self._ended.clear()

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self._name)
        if found is not None:
            self._seen[event.progress.batchId] = found.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.set()
