"""Keyed state: what a key has seen so far, in RocksDB, carried over restarts by the checkpoint."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR_US = 3_600_000_000


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on disk beside the executor and in the checkpoint."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class LatestAddress(StatefulProcessor):
    """The address with the highest number of a (book, role). A deletion is kept as such, so that older addresses that
    arrive after it do not come back; of equal numbers a deletion counts, then the greater address."""

    SCHEMA = "ebook bigint, role string, seq bigint, email string, deleted boolean"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "seq bigint, deleted boolean, email string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = tuple(self.latest.get()) if self.latest.exists() else None
        best = max([(r.seq, r.deleted, "" if r.deleted else r.email) for r in rows] + ([known] if known else []))
        if best != known:
            self.latest.update(best)
            yield Row(ebook=key[0], role=key[1], seq=best[0], email=None if best[1] else best[2], deleted=best[1])

    def close(self) -> None:
        pass


class SettledHours(StatefulProcessor):
    """Changes of a book gathered for an hour from the first one, then given out as one rebuild.

    The times of a book wait until the watermark has passed their hour, so the hours do not depend on how changes are
    dealt to batches. A timer stands at the end of the first hour that is open.
    """

    SCHEMA = "book bigint, first_us bigint, last_us bigint, n_changes bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getMapState("times", "at bigint", "n bigint")
        self.due = handle.getValueState("due", "ms bigint")

    def _wait_for(self, first: int | None) -> None:
        """Moves the timer to the end of the hour that begins at `first`."""
        ms = None if first is None else -(-(first + HOUR_US) // 1000)
        old = self.due.get()[0] if self.due.exists() else None
        if ms == old:
            return
        if old is not None:
            self.handle.deleteTimer(old)
            self.due.clear()
        if ms is not None:
            self.handle.registerTimer(ms)
            self.due.update((ms,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            at = (row.at,)
            seen = self.times.getValue(at)[0] if self.times.containsKey(at) else 0
            self.times.updateValue(at, (seen + 1,))
        self._wait_for(min(k[0] for k in self.times.keys()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self.due.clear()
        waiting = sorted((k[0], v[0]) for k, v in self.times.iterator())
        while waiting and waiting[0][0] + HOUR_US <= passed:
            first = waiting[0][0]
            hour = [(at, n) for at, n in waiting if at < first + HOUR_US]
            waiting = waiting[len(hour) :]
            for at, _ in hour:
                self.times.removeKey((at,))
            yield Row(book=key[0], first_us=first, last_us=hour[-1][0], n_changes=sum(n for _, n in hour))
        self._wait_for(waiting[0][0] if waiting else None)

    def close(self) -> None:
        pass
