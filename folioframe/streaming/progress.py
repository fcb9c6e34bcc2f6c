"""What Spark reports about running streams: rows read, rows dropped behind the watermark, observed metrics."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class StreamTotals(StreamingQueryListener):
    """Sums over the batches of every stream that runs while this listens."""

    def __init__(self) -> None:
        self.rows = self.dropped = 0
        self.observed: dict[str, int] = defaultdict(int)
        self._open, self._idle = 0, threading.Condition()

    def onQueryStarted(self, event) -> None:
        with self._idle:
            self._open += 1

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.rows += progress.numInputRows
        self.dropped += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        for metric, row in progress.observedMetrics.items():
            for name, value in row.asDict().items():
                self.observed[f"{metric}.{name}"] += value or 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._idle:
            self._open -= 1
            self._idle.notify_all()

    def wait(self, seconds: float = 60) -> None:
        """Until all that has started is reported as ended; events come a little after the streams."""
        with self._idle:
            self._idle.wait_for(lambda: self._open <= 0, seconds)


@contextmanager
def stream_totals(spark: SparkSession) -> Iterator[StreamTotals]:
    """Totals of the streams started inside; complete once the block is left."""
    totals = StreamTotals()
    spark.streams.addListener(totals)
    try:
        yield totals
        totals.wait()
    finally:
        spark.streams.removeListener(totals)
