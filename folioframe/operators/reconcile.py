"""Presence audits that remember: only what changed since the last audit is compared again.

Files and listing are dealt to buckets by path. A bucket's digest of either side (rows, and two sums of 64-bit hashes of
its rows, which no order changes and repeated rows do change) is made in one scan and combined before the shuffle, so
that a few numbers a bucket are all that moves. Where both digests are those of the last audit its findings stand; the
rows of other buckets are compared. Digests and findings are kept in one version of a store, so an audit that fails or
loses against another leaves the last one as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import MISSING_ON_DISK
from ..sinks.bucket_store import BucketStore
from .changes import full_paths, missing_files

BUCKETS = 1024


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def digests(rows: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    """bucket, n, s1, s2: equal for equal collections of rows, in any order."""
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)")).cast("decimal(38,0)")
    return rows.groupBy(bucket_of(F.col(key), buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), total(1).alias("s1"), total(2).alias("s2"))


def changed_buckets(now: DataFrame, before: DataFrame) -> list[int]:
    """Buckets whose digests, of any side, are not those of `before`; at most one number for each bucket."""
    columns = ["side", "bucket", "n", "s1", "s2"]
    odd = now.select(columns).exceptAll(before.select(columns)).unionByName(before.select(columns).exceptAll(now.select(columns)))
    return sorted(r.bucket for r in odd.select("bucket").distinct().collect())


def _marks(touched: list[int], buckets: int) -> list[bool]:
    """For each bucket whether it is touched: one look-up a row, however many are."""
    wanted = set(touched)
    return [b in wanted for b in range(buckets)]


def audit_presence(files: DataFrame, listing: DataFrame, public_dir: str, store: BucketStore, buckets: int = BUCKETS) -> tuple[DataFrame, list[int]]:
    """Files not yet marked missing whose full path the listing lacks (all columns of `files` and full_path), and the
    buckets that had to be compared. `listing` has full_path."""
    known = full_paths(files.filter(F.col("diskstatus") != MISSING_ON_DISK), public_dir)
    sides = {"files": (known, known.columns), "listing": (listing, ["full_path"])}
    change = store.begin()
    now = [digests(rows, "full_path", columns, buckets).withColumn("side", F.lit(side)) for side, (rows, columns) in sides.items()]
    change.create("digests", now[0].unionByName(now[1]), "bucket", 1)
    fresh = store.rows("digests", {"tables": change.tables})
    if "missing" in change.tables:
        touched = changed_buckets(fresh, change.read("digests"))
    else:
        touched = sorted(r.bucket for r in fresh.select("bucket").distinct().collect())
    some = len(touched) < buckets  # where all are compared no bucket need be looked up, nor a path made again for it
    here = F.get(F.lit(_marks(touched, buckets)), bucket_of(F.col("full_path"), buckets)) if some else F.lit(True)
    again = missing_files(files, listing.filter(here), public_dir).filter(here)
    again = again.select(*known.columns)
    if "missing" not in change.tables:
        change.create("missing", again, "full_path", 16)
    elif touched:
        kept = change.read("missing").filter(~here) if some else change.read("missing").limit(0)
        change.create("missing", kept.unionByName(again), "full_path", 16)
    change.commit()
    return store.read("missing"), touched
