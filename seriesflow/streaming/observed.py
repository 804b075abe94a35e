"""Counters of a running stream, from metrics that its tasks observe on the way."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..sources.readers import unpack_scrapes

COUNTED = ("batches_processed", "samples_processed", "samples_produced")


def observed(rows: DataFrame, name: str) -> DataFrame:
    """rows, counted under a name in each micro-batch's progress. No job is needed for it."""
    return rows.observe(name, F.count(F.lit(1)).alias("n"))


def counted_samples(scrapes: DataFrame) -> DataFrame:
    """The samples of a stream of scrapes; counts both."""
    return observed(unpack_scrapes(observed(scrapes, "batches_processed")), "samples_processed")


def counted_points(points: DataFrame) -> DataFrame:
    return observed(points, "samples_produced")


class PipelineStats(StreamingQueryListener):
    """What streams have processed and produced, by query and micro-batch: one that is repeated counts once.

    Add it with spark.streams.addListener. Progress reaches listeners a little after a micro-batch ends."""

    def __init__(self) -> None:
        self._seen: dict[tuple[str, int], dict[str, int]] = {}
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = {k: row.n for k, row in progress.observedMetrics.items() if k in COUNTED and row is not None}
        with self._change:
            mine = self._seen.setdefault((str(progress.id), progress.batchId), {})
            # A micro-batch may be told of twice, the second time without data.
            mine.update({k: n for k, n in found.items() if n >= mine.get(k, 0)})
            self._change.notify_all()

    def wait_for(self, query, seconds: float = 30.0) -> None:
        """Until the last micro-batch of a query that has ended is counted."""
        last = query.lastProgress
        if last is None:
            return
        at = (str(last["id"]), last["batchId"])
        with self._change:
            self._change.wait_for(lambda: at in self._seen, seconds)

    def totals(self) -> dict[str, int]:
        with self._change:
            return {k: sum(x.get(k, 0) for x in self._seen.values()) for k in COUNTED}
