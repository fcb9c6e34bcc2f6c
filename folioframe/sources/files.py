"""File sources. Each reader is a listing of files; what it means is an operator over that listing,
so that a stream, a folder or a table of files feeds the same code."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import IMAGE_LOG_COLUMNS
from ..functions.paths import base_name, is_parseable, is_readable, metadata_key
from ..functions.texts import decoded


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Every file under a folder: path, length, content. The content is read only if it is used."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "length", "modificationTime", "content")


def list_names(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Paths of a spool folder, empty files included: file readers pass those over, so the names
    come from Spark's own file index, which the driver holds for any scan."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).inputFiles()
    return spark.createDataFrame([(name,) for name in names], "path string")


def read_texts(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Small spool files, one row each."""
    return list_files(spark, folder, glob).select("path", decoded(F.col("content")).alias("text"))


# --- fixed values: artefacts a bundle takes -----------------------------------------------------
ARTIFACT_PATTERNS = {"txt": r"/[0-9]+/pg[0-9]+\.txt$", "rdf": r"\.rdf$"}
PRUNED_PATTERN = r"(?:^|/)(?:[^/]*\.delete|DELETE[^/]*)(?:/|$)"


def scan_artifacts(listing: DataFrame, kind: str) -> DataFrame:
    """Published files of a kind, in path order; whatever lies in a retired folder is left out."""
    kept = listing.filter(F.col("path").rlike(ARTIFACT_PATTERNS[kind]) & ~F.col("path").rlike(PRUNED_PATTERN))
    return kept.select("path", "length").orderBy("path")


def scan_book_dir(listing: DataFrame) -> DataFrame:
    """Readable files of book folders with the key that sorts the best metadata first."""
    book = F.regexp_extract("path", r"/([0-9]+)/[^/]+$", 1).try_cast("bigint")
    kept = listing.filter(is_readable(F.col("path")))
    return kept.select("path", "length", book.alias("ebook"), metadata_key(F.col("path")).alias("sort_key"))


def spool_books(listing: DataFrame, suffix_pattern: str) -> DataFrame:
    """Files named `<number><suffix>` with the number; other names are not part of the spool."""
    number = F.regexp_extract(base_name(F.col("path")), rf"^(\d+){suffix_pattern}$", 1)
    return listing.withColumn("ebook", F.nullif(number, F.lit("")).try_cast("bigint")).filter(F.col("ebook").isNotNull())


def trigger_books(listing: DataFrame) -> DataFrame:
    return spool_books(listing, r"\.zip\.trig").select("ebook", "path")


def notice_queue(texts: DataFrame) -> DataFrame:
    """Queued notices that say something."""
    return spool_books(texts, r"\.txt").filter(F.col("text") != "").select("ebook", F.col("text").alias("record"))


_MEMBER = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("data", T.BinaryType()), T.StructField("problem", T.StringType())]
)


@F.udtf(returnType=_MEMBER)
class ZipMembers:
    """Members of one archive, one at a time; an archive that cannot be read gives one row saying so."""

    def eval(self, content):
        try:
            with zipfile.ZipFile(io.BytesIO(bytes(content))) as archive:
                for member in archive.infolist():
                    if not member.is_dir():
                        yield member.filename, archive.read(member), None
        except (zipfile.BadZipFile, NotImplementedError, RuntimeError) as problem:
            yield None, None, type(problem).__name__


def zip_members(archives: DataFrame) -> DataFrame:
    """Parseable members of each archive as text, with the key that sorts the best metadata first."""
    members = archives.lateralJoin(ZipMembers(F.col("content").outer())).drop("content")
    kept = members.filter(F.col("problem").isNotNull() | is_parseable(F.col("name")))
    return kept.withColumn("text", decoded(F.col("data"))).withColumn("sort_key", metadata_key(F.col("name"))).drop("data")


def read_image_log(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{name} STRING" for name in IMAGE_LOG_COLUMNS)
    return spark.read.schema(schema).option("header", "false").option("escape", '"').csv(path)


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their numbers. Large logs stay split: a line's number is its place in its block
    plus the lines of the blocks before, and only block counts are summed per file."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"),
    )
    counts = raw.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_id") - F.min("_id").over(Window.partitionBy("file", "_block"))
    placed = raw.withColumn("_place", place).join(starts, ["file", "_block"])
    return placed.select("file", (F.col("_start") + F.col("_place") + 1).cast("bigint").alias("line_no"), "line")
