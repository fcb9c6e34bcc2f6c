"""Changelog streams: rebuilds, counts, activity, edit bursts, late changes, edited titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.changes import classify_changelog
from .runner import drain_batches
from .state import SettledHours

WATERMARK = "1 hour"


def timed_changes(changelog: DataFrame) -> DataFrame:
    """Classified changes with an event time a watermark accepts."""
    return classify_changelog(changelog).withColumn("time", F.col("time").cast("timestamp"))


def settled_rebuilds(changes: DataFrame) -> DataFrame:
    """One rebuild per book for all its changes within an hour of the first; the next change after that opens a new hour.

    A rebuild comes out when its hour has settled, so that it covers every change it stands for. To be run inside
    `rocksdb_state`.
    """
    keyed = changes.filter(F.col("book").isNotNull()).select("book", "time", F.unix_micros("time").alias("at")).withWatermark("time", WATERMARK)
    hours = keyed.groupBy("book").transformWithState(SettledHours(), SettledHours.SCHEMA, "Append", "EventTime")
    at = lambda c: F.timestamp_micros(c)
    return hours.select("book", at("first_us").alias("first"), at("last_us").alias("last"), "n_changes")


def rebuilds_at_once(changes: DataFrame) -> DataFrame:
    """A rebuild at the first change seen of a book, and none for what follows within the watermark's delay of it. Quick,
    but a change that comes after the rebuild and within the delay waits for the book's next one."""
    keyed = changes.filter(F.col("book").isNotNull()).select("book", "time").withWatermark("time", WATERMARK)
    return keyed.dropDuplicatesWithinWatermark(["book"])


def on_time(changes: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Changes that are not behind the watermark, each once; Spark counts the others as dropped."""
    return changes.withWatermark("time", delay).dropDuplicates(["id", "time"])


def change_counts(changes: DataFrame) -> DataFrame:
    timed = changes.withColumn("kind", F.coalesce("kind", F.lit("other"))).withWatermark("time", WATERMARK)
    counted = timed.groupBy(F.window("time", "1 hour"), "kind").agg(F.count(F.lit(1)).alias("n_changes"))
    return counted.select("window.start", "window.end", "kind", "n_changes")


def sliding_activity(changes: DataFrame) -> DataFrame:
    counted = changes.withWatermark("time", WATERMARK).groupBy(F.window("time", "1 day", "6 hours")).agg(F.count(F.lit(1)).alias("n_changes"))
    return counted.select("window.start", "window.end", "n_changes")


def edit_sessions(changes: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Bursts of changes to a book: rebuild once they have settled."""
    keyed = changes.filter(F.col("book").isNotNull()).withWatermark("time", WATERMARK)
    grouped = keyed.groupBy("book", F.session_window("time", gap)).agg(F.count(F.lit(1)).alias("n_changes"))
    return grouped.select("book", "session_window.start", "session_window.end", "n_changes")


def edited_titles(changes: DataFrame, attributes: DataFrame) -> DataFrame:
    """Books of changed titles: the stream joins the attribute table on its key."""
    keyed = changes.filter(F.col("attribute").isNotNull()).select("id", F.col("attribute").alias("pk"))
    return keyed.join(attributes.select("pk", "fk_books").distinct(), "pk").select("id", "fk_books")


def split_late(changes: DataFrame, folder: str, delay: str = WATERMARK) -> None:
    """Keeps changes that come too late for the watermark in a side table instead of losing them.

    A row is late if Spark would drop it: at or before the newest time of earlier batches, in milliseconds, less the delay. Batches
    are written under their number, so a repeated batch replaces itself. What came is observed as `changes.n`.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark, late = batch.sparkSession, F.lit(False)
        if number:
            newest = spark.read.schema("time TIMESTAMP, batch BIGINT").option("recursiveFileLookup", "true").parquet(f"{folder}/newest")
            limit = newest.filter(F.col("batch") < number).agg(F.date_trunc("millisecond", F.max("time")).alias("t")).scalar() - F.expr(f"INTERVAL {delay}")
            late = F.coalesce(F.col("time") <= limit, late)
        marked, path = batch.withColumn("kept_as", F.when(late, "late").otherwise("on_time")), f"{folder}/rows/n={number}"
        marked.write.mode("overwrite").partitionBy("kept_as").parquet(path)
        written = spark.read.schema(batch.schema).parquet(path)
        written.agg(F.max("time").alias("time"), F.lit(number).cast("bigint").alias("batch")).write.mode("overwrite").parquet(f"{folder}/newest/n={number}")

    drain_batches(changes.observe("changes", F.count(F.lit(1)).alias("n")), folder, handle)
