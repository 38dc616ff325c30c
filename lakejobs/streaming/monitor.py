"""Batch durations and totals of a stream, one record per batch for its whole run."""

from __future__ import annotations

import json
import threading
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from lakejobs.operators.audit import RunStats
from lakejobs.session import new_path, write_text_file

SLOW_MS = 1000


@dataclass(frozen=True)
class BatchTiming:
    """One micro-batch: its rows and how long it took."""

    batch_id: int
    rows: int
    duration_ms: int
    slow: bool


def is_slow(duration_ms: int, threshold_ms: int = SLOW_MS) -> bool:
    """Longer than the threshold; exactly at it is not slow."""
    return duration_ms > threshold_ms


class BatchLog(StreamingQueryListener):
    """Running totals of every query, and a file per batch that had input.

    Only sums are held in memory, so a run may have any number of batches. Add
    it to the session before a query starts:
    `spark.streams.addListener(BatchLog(spark))`.
    """

    def __init__(
        self, spark: SparkSession, path: str | None = None, threshold_ms: int = SLOW_MS
    ) -> None:
        self.spark = spark
        self.path = path or new_path(spark, "batches")
        self.threshold_ms = threshold_ms
        self._totals: dict[str, list[int]] = {}
        self._ended: dict[str, tuple[threading.Event, list[str | None]]] = {}
        self._lock = threading.Lock()

    def _end(self, run: str) -> tuple[threading.Event, list[str | None]]:
        with self._lock:
            return self._ended.setdefault(run, (threading.Event(), [None]))

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        timing = BatchTiming(
            p.batchId, p.numInputRows, p.batchDuration, is_slow(p.batchDuration, self.threshold_ms)
        )
        with self._lock:
            total = self._totals.setdefault(str(p.runId), [0, 0])
            total[0] += timing.rows
            total[1] += 1
        name = f"{self.path}/run={p.runId}/batch-{p.batchId}.json"
        write_text_file(self.spark, name, json.dumps(asdict(timing)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        done, error = self._end(str(event.runId))
        error[0] = event.exception
        done.set()

    def timings(self, query: StreamingQuery) -> DataFrame:
        """batch_id, rows, duration_ms and slow of every batch of a query's run."""
        schema = "batch_id long, rows long, duration_ms long, slow boolean"
        return self.spark.read.schema(schema).json(f"{self.path}/run={query.runId}")

    def stats(self, query: StreamingQuery, timeout_sec: float = 60) -> RunStats:
        """Rows and batches of a finished query, and the error that ended it.

        Waits until the listener has heard of the end, as events come late.
        """
        done, error = self._end(str(query.runId))
        if not done.wait(timeout_sec):
            raise TimeoutError("the query has not ended")
        rows, batches = self._totals.get(str(query.runId), [0, 0])
        return RunStats(rows, batches, int(error[0] is not None), error[0])
