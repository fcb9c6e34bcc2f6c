"""Audits that remember: the same findings as a full comparison, from few buckets."""

from pyspark.sql import functions as F

from folioframe.operators import changes, reconcile
from folioframe.sinks.bucket_store import BucketStore

FILES = "id bigint, archive_path string, diskstatus int"
ROOT = "/srv/library"


def table(spark, rows):
    return spark.createDataFrame(rows, FILES)


def listed(spark, names):
    return changes.full_paths(spark.createDataFrame([(n,) for n in names], "archive_path string"), ROOT).select("full_path")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_only_changed_buckets_are_compared(spark, tmp_path):
    rows = [(k, f"cache/epub/{k}/{k}.txt", 5 if k % 50 == 0 else 0) for k in range(2000)] + [(9000, "cache/epub/7/7.txt", 0), (9001, None, 0)]
    names = [f"cache/epub/{k}/{k}.txt" for k in range(2000) if k % 40] + ["cache/epub/3/3.txt", "cache/epub/extra.txt"]
    store = BucketStore(spark, str(tmp_path))

    def audit(rows, names):
        found, touched = reconcile.audit_presence(table(spark, rows), listed(spark, names), ROOT, store, buckets=64)
        assert ids(found) == ids(changes.missing_files(table(spark, rows), listed(spark, names), ROOT))
        return touched

    assert len(audit(rows, names)) == 64
    assert audit(rows[::-1], names[::-1]) == []
    assert len(audit(rows, names[1:])) == 1
    assert 1 <= len(audit([*rows[:500], *rows[502:], (9002, "cache/epub/new.txt", 0)], names[1:])) <= 3
    twice = [*names[1:], "cache/epub/3/3.txt"]
    assert len(audit(rows, twice)) >= 1
    assert len(audit([], names)) == 64 and len(audit(rows, [])) == 64


def test_digests_see_pairs_of_equal_rows(spark):
    digest = lambda names: [tuple(r) for r in reconcile.digests(spark.createDataFrame([(n,) for n in names], "k string").withColumn("key", F.lit(1)), "key", ["k"], 4).collect()]
    assert digest(["a", "a", "c"]) == digest(["c", "a", "a"]) != digest(["b", "b", "c"])
