"""Scans and lookups over catalog tables. Filters stay plain so that they reach the parquet reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import DUMMY_BOOK


def real_books(books: DataFrame, dummy: int = DUMMY_BOOK) -> DataFrame:
    """All books but the one id that stands for no book."""
    return books.filter(F.col("pk") != dummy)


def scan_books(books: DataFrame, dummy: int = DUMMY_BOOK) -> DataFrame:
    return real_books(books, dummy).select("pk").orderBy("pk")


def scan_text_books_range(
    books: DataFrame, categories: DataFrame, low: int | None = None, high: int | None = None, dummy: int = DUMMY_BOOK
) -> DataFrame:
    """Books that no category marks as audio, data or images; a bound of None leaves the range open on that side."""
    in_range = real_books(books, dummy)
    if low is not None:
        in_range = in_range.filter(F.col("pk") >= low)
    if high is not None:
        in_range = in_range.filter(F.col("pk") <= high)
    marked = categories.select(F.col("fk_books").alias("pk"))
    return in_range.join(marked, "pk", "left_anti")


def live_files(files: DataFrame) -> DataFrame:
    return files.filter((F.col("compression") == "none") & (F.col("diskstatus") == 0) & (F.col("obsoleted") == 0))


def live_file_order() -> list[Column]:
    """Type, encoding, newest first; absent values sort as the catalog's database sorts them."""
    return [
        F.col("fk_filetypes").asc_nulls_last(),
        F.col("fk_encodings").asc_nulls_last(),
        F.col("modified").desc_nulls_first(),
    ]


def scan_attributes(attributes: DataFrame, *codes: int) -> DataFrame:
    return attributes.filter(F.col("fk_attriblist").isin(*codes))


def scan_changelog_window(changelog: DataFrame, asof: str, hours: int) -> DataFrame:
    since = F.lit(asof).cast("timestamp_ntz") - F.expr(f"make_dt_interval(0, {hours}, 0, 0)")
    return changelog.filter(F.col("time") >= since)


def scan_posts(posts: DataFrame, medium: str) -> DataFrame:
    return posts.filter(F.col("media") == medium)


def max_book(books: DataFrame) -> DataFrame:
    return books.agg(F.max("pk").alias("last_book"))


def recent_books(books: DataFrame, since: str) -> DataFrame:
    return books.filter(F.col("release_date") >= F.lit(since).cast("date")).select("pk")


def top_books(books: DataFrame, n: int) -> DataFrame:
    """The n most downloaded: each task keeps n rows, one merge keeps the best n."""
    return books.orderBy(F.col("downloads").desc_nulls_last(), "pk").limit(n).select("pk", "downloads")


def filetype_books(files: DataFrame, filetype: str) -> DataFrame:
    return files.filter(F.col("fk_filetypes") == filetype).select(F.col("fk_books").alias("pk")).distinct()


def nontext_books(books: DataFrame, categories: DataFrame) -> DataFrame:
    return books.join(categories.select(F.col("fk_books").alias("pk")), "pk", "left_semi").select("pk")
