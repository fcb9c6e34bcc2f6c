"""Converter logs and page images."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import ALT_TEXT_CHARS, IMAGE_COLUMNS, IMAGE_ITEM_PATTERN, LOG_CONTEXT_LINES, LOG_PHRASES
from ..functions.paths import join_url
from ..profile import DEFAULT, LibraryProfile


def log_hits(lines: DataFrame) -> DataFrame:
    """Lines that belong to a report; a line may belong to several."""
    found = F.array_compact(F.array(*[F.when(F.col("line").contains(p), F.lit(r)) for r, p in LOG_PHRASES.items()]))
    return lines.select("*", F.explode(found).alias("report"))


def with_context(lines: DataFrame, report: str = "whitewash", around: int = LOG_CONTEXT_LINES) -> DataFrame:
    """Hit lines of a report with `around` lines on each side, overlaps once.

    Hits name the line numbers they want; lines join on those, so a long log is never one group.
    `lines` is (file, line_no, line).
    """
    hits = log_hits(lines).filter(F.col("report") == report)
    wanted = hits.select("file", F.explode(F.sequence(F.col("line_no") - around, F.col("line_no") + around)).alias("line_no"))
    return lines.join(wanted.distinct(), ["file", "line_no"], "left_semi")


def log_report(lines: DataFrame) -> DataFrame:
    """Lines per log and report."""
    return log_hits(lines).groupBy("file", "report").agg(F.count(F.lit(1)).alias("n_lines"), F.min("line_no").alias("first_line"))


def image_rows(log: DataFrame, profile: LibraryProfile = DEFAULT) -> DataFrame:
    """Log rows of catalog books with the book, the image's path and address, and a bounded alt text."""
    item = F.regexp_extract("src", IMAGE_ITEM_PATTERN, 1)
    path = join_url(F.concat(F.lit(profile.cache_dir), F.col("item"), F.lit("/")), F.col("rel_url"))
    home = F.concat(F.lit(profile.cache_dir), F.col("item"), F.lit("/"))
    inside = F.substr(F.col("path"), F.length(home) + 1)
    url = F.when(F.col("path").startswith(home), inside).otherwise(
        F.regexp_replace(F.col("path"), "^" + profile.cache_dir.replace(".", r"\.") + r"\d+/", "")
    )
    keyed = log.withColumn("item", item).filter(F.col("item") != "").withColumn("path", path)
    alt = F.coalesce(F.substring("alt_txt", 1, ALT_TEXT_CHARS), F.lit(""))
    return keyed.select("item", "img_id", alt.alias("alt_txt"), url.alias("img_url"), "in_a_figure", "path")


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def _number(content: Column, start: int, size: int, little: bool = False) -> Column:
    digits = F.hex(F.substring(content, start, size))
    if little:
        digits = F.concat(F.substring(digits, 3, 2), F.substring(digits, 1, 2))
    return F.conv(digits, 16, 10).cast("int")


def _jpeg_size(data: bytes) -> tuple[int | None, int | None]:
    """Width and height from the first frame header; (None, None) if there is none."""
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            return None, None
        marker, length = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
        at += 1 if marker == 0xFF else 2 + length
    return None, None


_SIZE = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())])


@F.pandas_udf(_SIZE)
def _jpeg_sizes(content: pd.Series) -> pd.DataFrame:
    sizes = pd.DataFrame([_jpeg_size(c) for c in content], columns=["x", "y"])
    return sizes.astype("Int32")


def image_facts(images: DataFrame) -> DataFrame:
    """Hash, length and pixel size of each file (path, content). PNG and GIF sizes are read by Spark
    itself; only JPEG files, whose headers must be walked, go through Python."""
    is_jpeg = F.substring("content", 1, 2) == F.unhex(F.lit("FFD8"))
    facts = [content_hash(F.col("content")).alias("hash"), F.octet_length("content").cast("bigint").alias("len")]
    content = F.col("content")
    png = F.substring("content", 1, 4) == F.unhex(F.lit("89504E47"))
    gif = F.substring("content", 1, 3) == F.unhex(F.lit("474946"))
    x = F.when(png, _number(content, 17, 4)).when(gif, _number(content, 7, 2, True))
    y = F.when(png, _number(content, 21, 4)).when(gif, _number(content, 9, 2, True))
    plain = images.filter(~is_jpeg).select("path", *facts, x.alias("x"), y.alias("y"))
    jpeg = images.filter(is_jpeg).select("path", *facts, _jpeg_sizes("content").alias("_size"))
    return plain.unionByName(jpeg.select("path", "hash", "len", "_size.x", "_size.y"))


def image_inventory(log: DataFrame, images: DataFrame, profile: LibraryProfile = DEFAULT) -> DataFrame:
    """One row per logged image; facts stay null where the file cannot be read. Bytes never join: only facts do."""
    return image_rows(log, profile).join(image_facts(images), "path", "left").select(*IMAGE_COLUMNS)
