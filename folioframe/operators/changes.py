"""Changed books: changelog statements, touched files, ids in range notation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    AUTHOR_BOOK_PATTERN,
    AUTHOR_DELETE_PREFIX,
    AUTHOR_INSERT_PREFIX,
    AUTHOR_UPDATE_PREFIX,
    INSERT_BOOK_PATTERN,
    MISSING_ON_DISK,
    TITLE_PK_PATTERN,
    TITLE_UPDATE_PREFIX,
)
from ..functions.paths import resolved_path


def change_kind(sql: Column) -> Column:
    return (
        F.when(sql.startswith(AUTHOR_UPDATE_PREFIX) | sql.startswith(AUTHOR_DELETE_PREFIX), "author_change")
        .when(sql.startswith(AUTHOR_INSERT_PREFIX), "author_add")
        .when(sql.startswith(TITLE_UPDATE_PREFIX), "title_change")
    )


def classify_changelog(changelog: DataFrame) -> DataFrame:
    """Kind of each statement with the book or the attribute it names; ids have two digits or more."""
    kind, sql = F.col("kind"), F.col("sql")
    found = lambda pattern: F.nullif(F.regexp_extract(sql, pattern, 1), F.lit("")).cast("bigint")
    book = F.when(kind == "author_change", found(AUTHOR_BOOK_PATTERN)).when(kind == "author_add", found(INSERT_BOOK_PATTERN))
    return changelog.withColumn("kind", change_kind(sql)).select(
        *changelog.columns, "kind", book.alias("book"), F.when(kind == "title_change", found(TITLE_PK_PATTERN)).alias("attribute")
    )


def attribute_books(changes: DataFrame, attributes: DataFrame) -> DataFrame:
    """Book behind each changed title. The changed ids are made distinct before the join."""
    changed = changes.filter(F.col("attribute").isNotNull()).select(F.col("attribute").alias("pk")).distinct()
    return attributes.select("pk", "fk_books").join(changed, "pk", "left_semi").distinct()


def books_to_rebuild(changes: DataFrame, attributes: DataFrame) -> DataFrame:
    direct = changes.filter(F.col("book").isNotNull()).select(F.col("book").alias("ebook"))
    titled = attribute_books(changes, attributes).select(F.col("fk_books").alias("ebook"))
    return direct.unionByName(titled).filter(F.col("ebook").isNotNull()).distinct()


def rebuild_batches(rebuild: DataFrame, ids_per_batch: int = 1000) -> DataFrame:
    """Comma lists for the build command; a list covers `ids_per_batch` ids at most."""
    batch = F.floor(F.col("ebook") / ids_per_batch).cast("bigint")
    listed = F.expr("listagg(CAST(ebook AS STRING), ',') WITHIN GROUP (ORDER BY ebook)")
    return rebuild.groupBy(batch.alias("batch")).agg(listed.alias("build_list"), F.count(F.lit(1)).alias("n_books"))


def changed_books(files: DataFrame, asof: str, days: int) -> DataFrame:
    since = F.lit(asof).cast("timestamp_ntz") - F.expr(f"make_dt_interval({days}, 0, 0, 0)")
    touched = (
        (F.col("modified") >= since)
        & ~F.col("archive_path").startswith("cache/")
        & (F.col("diskstatus") != MISSING_ON_DISK)
        & F.col("fk_books").isNotNull()
    )
    return files.filter(touched).select("fk_books").distinct()


def full_paths(rows: DataFrame, public_dir: str) -> DataFrame:
    """Adds `full_path`, '' for an absent path: a key that is never null needs no null test of its long expression."""
    return rows.withColumn("full_path", F.coalesce(resolved_path(F.col("archive_path"), public_dir), F.lit("")))


def missing_files(files: DataFrame, listing: DataFrame, public_dir: str) -> DataFrame:
    """Files not yet marked missing whose full path the listing lacks."""
    known = full_paths(files.filter(F.col("diskstatus") != MISSING_ON_DISK), public_dir)
    return known.join(listing.select("full_path"), "full_path", "left_anti")


RANGE_BLOCK = 1 << 16


def parse_range_items(requests: DataFrame, text: str, last_book: DataFrame) -> DataFrame:
    """Items of `"1,2-4,6,8-"` as bounds; `ok` is false for an item that is no number or no range."""
    items = requests.select("*", F.posexplode(F.split(text, ",")).alias("item_pos", "item"))
    single = F.regexp_extract("item", r"^\s*(\d+)\s*$", 1).try_cast("bigint")
    pair = r"^(?:\s*(\d+)\s*)?-(?:\s*(\d+)\s*)?$"
    is_pair = F.col("item").rlike(pair)
    low = F.coalesce(F.regexp_extract("item", pair, 1).try_cast("bigint"), F.lit(1))
    high = F.coalesce(F.regexp_extract("item", pair, 2).try_cast("bigint"), last_book.scalar())
    bounded = items.select(
        "*",
        F.when(is_pair, low).otherwise(single).alias("low"),
        F.when(is_pair, high).otherwise(single).alias("high"),
    )
    return bounded.withColumn("ok", F.coalesce(F.col("low") <= F.col("high"), F.lit(False)))


def expand_range_items(items: DataFrame) -> DataFrame:
    """Ids of the good items. Wide ranges are cut into blocks and spread before they are expanded."""
    good = items.filter("ok").withColumn("_from", F.explode(F.sequence("low", "high", F.lit(RANGE_BLOCK).cast("bigint"))))
    spread = good.repartition("req_id", "item_pos", "_from")
    upto = F.least(F.col("_from") + (RANGE_BLOCK - 1), F.col("high"))
    return spread.select("req_id", "item_pos", F.explode(F.sequence("_from", upto)).alias("ebook"))


def range_predicate(text: str, column: Column, last_book: int) -> Column:
    """The same notation given as an argument: a filter the parquet reader can prune with."""
    keep = F.lit(False)
    for item in text.split(","):
        ends = item.split("-")
        try:
            low = int(ends[0] or 1) if len(ends) == 2 else int(item)
            high = int(ends[1] or last_book) if len(ends) == 2 else low
        except ValueError:
            continue
        if low <= high:
            keep = keep | column.between(low, high)
    return keep


def rebuild_day(book: Column, per_day: int) -> Column:
    """Day of the month whose nightly run rebuilds a book."""
    return (F.floor(book / per_day) + 1).cast("bigint")


def reindex_day(book: Column, per_day: int) -> Column:
    return F.floor(book / per_day).cast("bigint")
