"""Spool streams: submissions, notices, addresses, posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.submissions import normal_email
from ..operators.lists import ordered_list
from ..plans.intake import workflow_records
from ..plans.outbox import notice_text, with_address
from ..profile import DEFAULT, LibraryProfile
from ..sinks.snapshots import new_posts
from ..sources.files import spool_books
from .runner import drain_batches
from .state import LatestAddress, rocksdb_state


def spool_stream(spark: SparkSession, folder: str, glob: str, archive: str | None = None) -> DataFrame:
    """New files of a spool folder, each once, as (path, text, time), the time being the file's. With `archive` read files move there."""
    reader = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", glob)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    facts = F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), F.col("_metadata.file_modification_time").alias("time")
    return reader.load(folder).select(*facts)


def submissions(files: DataFrame) -> DataFrame:
    """Metadata rows of arriving submissions (path, text)."""
    return workflow_records(spool_books(files, r"\.json"))


def with_submissions(triggers: DataFrame, records: DataFrame, within: str = "12 hours", delay: str = "1 hour") -> DataFrame:
    """Triggers (id, ebook, time) beside the submissions of their book (seq, ebook, time, valid, title, credit) that arrive
    within a span before or after.

    Pairs come out as soon as both are there, however late the submission within that span; a trigger without any comes
    out alone once the watermark, the lesser one of both streams, has passed its span, and its state goes. After a restart
    the watermark moves on when both streams have had rows.
    """
    left = triggers.select("id", "ebook", F.col("time").cast("timestamp").alias("time")).withWatermark("time", delay)
    right = records.select(F.col("ebook").alias("_ebook"), F.col("time").cast("timestamp").alias("arrived"), "seq", "valid", "title", "credit").withWatermark("arrived", delay)
    near = f"ebook = _ebook AND arrived >= time - INTERVAL {within} AND arrived <= time + INTERVAL {within}"
    return left.join(right, F.expr(near), "leftOuter").drop("_ebook")


def best_submissions(pairs: DataFrame) -> DataFrame:
    """One row per trigger: the newest valid submission it met, else the newest, else none."""
    order = F.struct("valid", "arrived", "seq")
    best = F.max_by(F.struct("seq", "valid", "title", "credit"), F.when(F.col("seq").isNotNull(), order)).alias("best")
    return pairs.groupBy("id", "ebook").agg(best).select("id", "ebook", "best.*")


def notices_by_book(notices: DataFrame, addresses: DataFrame, folder: str, profile: LibraryProfile = DEFAULT) -> None:
    """One message per book and batch of notices (id, ebook, record), with the manager's address."""

    def handle(batch: DataFrame, number: int) -> None:
        listed = ordered_list(batch, ["ebook"], "id", "record", "records", "\n")
        messages = listed.select("ebook", F.lit("ww").alias("role"), notice_text(profile.critical_text, F.col("ebook"), F.col("records"), profile).alias("message"))
        with_address(messages, addresses).write.mode("overwrite").parquet(f"{folder}/rows/n={number}")

    drain_batches(notices, folder, handle)


def latest_addresses(emails: DataFrame, folder: str, profile: LibraryProfile = DEFAULT) -> None:
    """Addresses from rows (seq, ebook, role, email) as keyed state; a true `deleted`, where there is such a column, takes
    the address away. Each batch writes the keys it changed under its number."""
    deleted = F.coalesce("deleted", F.lit(False)) if "deleted" in emails.columns else F.lit(False)
    clean = emails.select("seq", F.col("ebook").try_cast("bigint").alias("ebook"), "role", normal_email(F.col("email"), profile).alias("email"), deleted.alias("deleted"))
    clean = clean.filter(F.col("ebook").isNotNull() & (F.col("email").isNotNull() | F.col("deleted")))

    def handle(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/n={number}")

    latest = clean.groupBy("ebook", "role").transformWithState(LatestAddress(), LatestAddress.SCHEMA, "Update", "None")
    with rocksdb_state(emails.sparkSession):
        drain_batches(latest, folder, handle, mode="update")


def current_addresses(spark: SparkSession, folder: str) -> DataFrame:
    """The addresses that stand after all batches."""
    rows = spark.read.schema(f"{LatestAddress.SCHEMA}, n int").parquet(f"{folder}/rows")
    last = rows.groupBy("ebook", "role").agg(F.max_by(F.struct("email", "deleted"), "n").alias("last"))
    return last.filter(~F.col("last.deleted")).select("ebook", "role", "last.email")


POST_BUCKETS = 64


def _posts_seen(spark: SparkSession, folder: str, keys: DataFrame, number: int) -> DataFrame:
    """Posts of batches before `number` that `keys` (bucket, fk_books, media) name.

    Posts lie in folders by bucket. The keys of a batch lie in a table of known size; where that is small Spark sends
    them to the scan of earlier posts and reads the folders of their buckets only. It does so for keys that a comparison
    has filtered, hence the one that always holds.
    """
    earlier = spark.read.schema("fk_books BIGINT, media STRING, time TIMESTAMP, bucket INT, n INT").option("basePath", f"{folder}/rows").parquet(f"{folder}/rows")
    return earlier.filter(F.col("n") < number).join(keys.filter("bucket >= 0"), ["bucket", "fk_books", "media"], "left_semi").select("fk_books", "media")


def post_once(sent: DataFrame, posts: DataFrame, folder: str, buckets: int = POST_BUCKETS) -> None:
    """Records each (book, medium) once, ever: against `posts` and against earlier batches."""
    bucket = F.pmod(F.xxhash64("fk_books", "media"), F.lit(buckets)).cast("int").alias("bucket")

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        arrived = f"{folder}/arrived/n={number}"
        batch.select("fk_books", "media", "time", bucket).write.mode("overwrite").parquet(arrived)
        rows = spark.read.schema("fk_books BIGINT, media STRING, time TIMESTAMP, bucket INT").parquet(arrived)
        known = posts.select("fk_books", "media")
        if number:
            known = known.unionByName(_posts_seen(spark, folder, rows.select("bucket", "fk_books", "media"), number))
        fresh = new_posts(known, rows).select("fk_books", "media", "time", bucket)
        fresh.repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/rows/n={number}")

    drain_batches(sent, folder, handle)
