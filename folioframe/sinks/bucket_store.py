"""Tables bucketed and sorted on a key, changed bucket by bucket under one manifest.

A version of the store is one manifest: for each table its schema, key and number of buckets, and for each bucket the
generation that holds its rows. A change writes new generations of the buckets it touches and refers to all others where
they are. It is made against the version it began with and published by a rename that only one writer can win, so all its
tables change at once; the loser gets `CommitConflict`. What was read of a version stays readable until `vacuum`.

Reading goes through Spark's own bucketed tables: the generations are the partitions of a table in the session's catalog,
so joins and groups on the key of tables with the same number of buckets need no exchange.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .commits import CommitConflict, delete, names_in, publish_text

__all__ = ["BucketStore", "Change", "CommitConflict"]
BUCKET = "_bucket"


def _bucket_of(key: Column, buckets: int) -> Column:
    """The bucket Spark's writer deals a key to."""
    return F.pmod(F.hash(key), F.lit(buckets))


class BucketStore:
    """Versions of a group of tables under a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self) -> list[int]:
        names = names_in(self.spark, f"{self.folder}/manifests")
        return sorted(int(n[2:-5]) for n in names if n.startswith("v-"))

    def manifest(self, version: int | None = None) -> dict:
        """Tables of a version, the newest by default; an empty store has version -1 and no tables."""
        if version is None:
            version = max(self.versions(), default=-1)
        if version < 0:
            return {"version": -1, "tables": {}}
        return json.loads(self.spark.read.text(self._manifest_path(version), wholetext=True).first()[0])

    def _manifest_path(self, version: int) -> str:
        return f"{self.folder}/manifests/v-{version:012d}.json"

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """Rows of a table as of a version."""
        return self.rows(name, self.manifest(version)).drop(BUCKET)

    def rows(self, name: str, manifest: dict) -> DataFrame:
        """Rows of a table in a manifest, with the number of their bucket."""
        table = manifest["tables"][name]
        schema = T.StructType.fromJson(table["schema"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        held = hashlib.md5(json.dumps([self.folder, name, table], sort_keys=True).encode()).hexdigest()
        view = f"bucket_store_{held}"
        if not self.spark.catalog.tableExists(view):
            key, location = table["key"], f"{self.folder}/data"
            self.spark.sql(
                f"CREATE TABLE {view} ({columns}, `{BUCKET}` INT) USING parquet PARTITIONED BY (`{BUCKET}`) "
                f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {table['buckets']} BUCKETS LOCATION '{location}'"
            )
            parts = [f"PARTITION (`{BUCKET}` = {b}) LOCATION '{location}/{g}/{BUCKET}={b}'" for b, g in table["generations"].items()]
            if parts:
                self.spark.sql(f"ALTER TABLE {view} ADD IF NOT EXISTS {' '.join(parts)}")
        return self.spark.table(view)

    def begin(self) -> Change:
        return Change(self)

    def vacuum(self, keep: int = 1) -> None:
        """Deletes all but the newest `keep` versions, and generations that none of those refers to. Not to be run
        beside a writer: what a change has written counts as unused until it is committed."""
        old, kept = self.versions()[:-keep], [self.manifest(v) for v in self.versions()[-keep:]]
        used = {g for m in kept for t in m["tables"].values() for g in t["generations"].values()}
        for version in old:
            delete(self.spark, self._manifest_path(version))
        for name in names_in(self.spark, f"{self.folder}/data"):
            if name not in used:
                delete(self.spark, f"{self.folder}/data/{name}")


class Change:
    """Changes of any tables of a store against the version it began with."""

    def __init__(self, store: BucketStore):
        self.store, self.base = store, store.manifest()
        self.tables = json.loads(json.dumps(self.base["tables"]))

    def read(self, name: str) -> DataFrame:
        """Rows of a table as they were when the change began."""
        return self.store.rows(name, self.base).drop(BUCKET)

    def create(self, name: str, rows: DataFrame, key: str, buckets: int) -> None:
        """A new table, or all of an old one anew."""
        table = {"key": key, "buckets": buckets, "schema": rows.schema.jsonValue(), "generations": {}}
        self.tables[name] = table
        table["generations"] = self._write(rows, table, _bucket_of(F.col(f"`{key}`"), buckets))

    def rewrite(self, name: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Replaces the buckets of `keys` by `change` of their rows; returns their numbers. Rows of other buckets in the
        result are an error. Buckets are few, so their numbers are collected."""
        table = self.tables[name]
        kind = T.StructType.fromJson(table["schema"])[table["key"]].dataType
        bucket = _bucket_of(F.col(f"`{table['key']}`"), table["buckets"])
        touched = keys.select(_bucket_of(F.col(keys.columns[0]).cast(kind), table["buckets"])).distinct().collect()
        touched = sorted(r[0] for r in touched)
        rows = self.store.rows(name, {"tables": self.tables}).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        strange = F.raise_error(F.lit(f"a row of {name} is outside the buckets that were to be rewritten")).cast("int")
        written = self._write(change(rows), table, F.when(bucket.isin(touched), bucket).otherwise(strange)) if touched else {}
        kept = {b: g for b, g in table["generations"].items() if int(b) not in touched}
        table["generations"] = kept | written
        return touched

    def _write(self, rows: DataFrame, table: dict, bucket: Column) -> dict[str, str]:
        """Writes a generation and returns it for each bucket that has rows."""
        spark, generation, key = self.store.spark, f"g-{uuid.uuid4().hex}", table["key"]
        columns = [f["name"] for f in table["schema"]["fields"]]
        dealt = rows.select(*[F.col(f"`{c}`") for c in columns], bucket.alias(BUCKET)).repartition(table["buckets"], F.col(f"`{key}`"))
        path, name = f"{self.store.folder}/data/{generation}", f"bucket_store_{generation[2:]}"
        dealt.write.format("parquet").partitionBy(BUCKET).bucketBy(table["buckets"], key).sortBy(key).option("path", path).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
        found = [n.split("=")[1] for n in names_in(spark, path) if n.startswith(f"{BUCKET}=")]
        return {b: generation for b in sorted(found, key=int)}

    def commit(self) -> int:
        """Publishes the change as the version after its base, or raises `CommitConflict`."""
        version = self.base["version"] + 1
        publish_text(self.store.spark, json.dumps({"version": version, "tables": self.tables}), self.store._manifest_path(version))
        return version
