"""Running a stream until it has read what is there, into files under shared storage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def drain_to_files(stream: DataFrame, folder: str) -> DataFrame:
    """Appends finished rows to parquet and returns the table. Restarts go on from the checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def drain_batches(stream: DataFrame, folder: str, handle: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Hands every micro-batch to `handle`, which must give the same result when a batch is repeated."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()
