"""Changes of tables as functions of their rows, and whole snapshots of small ones; `bucket_store` changes parts of large ones."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import number_ids
from .commits import names_in, publish


def upsert_attribute(attributes: DataFrame, changes: DataFrame, code: int, whole: DataFrame | None = None) -> DataFrame:
    """Attributes after setting `code` on the books of `changes` (fk_books, text).

    The first row of the book with that code takes the text; without one a row is added; a null
    text deletes the first row. Rows with other codes pass by untouched. Where `attributes` is a part
    of a table, `whole` is the table, after whose highest number new rows are numbered.
    """
    is_code = F.col("fk_attriblist") == code
    same_code = attributes.filter(is_code)
    firsts = same_code.groupBy("fk_books").agg(F.min(F.struct("pk", "text")).alias("_first"))
    target = changes.select("fk_books", F.col("text").alias("_new"), F.lit(True).alias("_changed")).join(firsts, "fk_books", "left")
    joined = same_code.join(target, "fk_books", "left")
    hit = F.coalesce(F.col("_changed") & (F.struct("pk", "text") == F.col("_first")), F.lit(False))
    kept = joined.filter(~(hit & F.col("_new").isNull())).withColumn("text", F.when(hit, F.col("_new")).otherwise(F.col("text")))
    added = target.filter(F.col("_first").isNull() & F.col("_new").isNotNull())
    places = number_ids(added.select("fk_books"), "fk_books", "_place")
    top = (attributes if whole is None else whole).agg(F.max("pk")).scalar()
    new = added.join(places, "fk_books").select(
        (F.coalesce(top, F.lit(0)) + 1 + F.col("_place")).alias("pk"),
        "fk_books",
        F.lit(code).alias("fk_attriblist"),
        F.col("_new").alias("text"),
        F.lit(0).alias("nonfiling"),
    )
    columns = ("pk", "fk_books", "fk_attriblist", "text", "nonfiling")
    rest = attributes.filter(~is_code)
    return rest.select(*columns).unionByName(kept.select(*columns)).unionByName(new)


def append_attributes(attributes: DataFrame, rows: DataFrame, code: int) -> DataFrame:
    """Attributes with a row added for each of `rows` (fk_books, text), numbered after the highest in order of book and text."""
    columns = ("pk", "fk_books", "fk_attriblist", "text", "nonfiling")
    books = number_ids(rows.select("fk_books"), "fk_books", "_place")
    most = rows.groupBy("fk_books").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).scalar()
    inside = F.row_number().over(Window.partitionBy("fk_books").orderBy("text")) - 1
    top = F.coalesce(attributes.agg(F.max("pk")).scalar(), F.lit(0))
    number = (top + 1 + F.col("_place") * F.coalesce(most, F.lit(1)) + F.col("_at")).cast("bigint").alias("pk")
    new = rows.withColumn("_at", inside).join(books, "fk_books")
    new = new.select(number, "fk_books", F.lit(code).alias("fk_attriblist"), "text", F.lit(0).alias("nonfiling"))
    return attributes.select(*columns).unionByName(new.select(*columns))


def upsert_files(files: DataFrame, scanned: DataFrame, retired: DataFrame) -> DataFrame:
    """Files after storing `scanned` and dropping the paths of `retired`; of a path the latest row holds."""
    columns = files.columns
    both = files.withColumn("_new", F.lit(0)).unionByName(scanned.select(*columns).withColumn("_new", F.lit(1)))
    latest = F.max_by(F.struct(*columns), F.struct("modified", "_new", "extent", "id")).alias("row")
    held = both.groupBy(F.col("archive_path").alias("_path")).agg(latest)
    return held.join(retired.select(F.col("archive_path").alias("_path")), "_path", "left_anti").select("row.*")


def new_posts(posts: DataFrame, sent: DataFrame) -> DataFrame:
    """Posts to append after sending: each (book, medium) once, and only if it is not there yet."""
    once = sent.groupBy("fk_books", "media").agg(F.min("time").alias("time"))
    return once.join(posts.select("fk_books", "media"), ["fk_books", "media"], "left_anti")


def forget_books(tables: dict[str, tuple[DataFrame, str]], gone: DataFrame) -> dict[str, DataFrame]:
    """Every table without the rows of the books in `gone` (pk); a table comes with its book column."""
    return {
        name: table.join(gone.select(F.col("pk").alias("_gone")), F.col(column) == F.col("_gone"), "left_anti")
        for name, (table, column) in tables.items()
    }


class SnapshotTable:
    """Versions of one table under a folder. A version is written aside and renamed when it is whole."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _versions(self) -> list[int]:
        names = [n for n in names_in(self.spark, self.folder) if n.startswith("v-")]
        return sorted(int(n[2:]) for n in names if "_SUCCESS" in names_in(self.spark, f"{self.folder}/{n}"))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/v-{self._versions()[-1]}")

    def replace(self, table: DataFrame) -> None:
        """The next version; `CommitConflict` if another writer has published one since this began."""
        version = max(self._versions(), default=-1) + 1
        aside = f"{self.folder}/.v-{version}-{uuid.uuid4().hex}"
        table.write.parquet(aside)
        publish(self.spark, aside, f"{self.folder}/v-{version}")
