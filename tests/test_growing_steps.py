"""Steps whose memory or time grew with the number of lists or buckets."""

from pyspark.sql import functions as F

from folioframe.operators import candidates, reconcile
from folioframe.plans import marc_feed
from folioframe.registry import stores
from folioframe.sinks.bucket_store import BucketStore


def _plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_all_preference_lists_are_numbered_in_one_sort(spark):
    schema = "fk_books int, id int, archive_path string, fk_filetypes string, fk_encodings string, modified timestamp, extent int, generated boolean, format string"
    rows = [(1, 1, "a", "html", None, None, 1, False, "html/unknown"), (1, 2, "b", "txt", "utf-8", None, 1, False, "txt/utf-8"), (1, 3, "c", "txt", "utf-8", None, 1, False, "txt/utf-8")]
    ranked = candidates.rank_candidates(spark.createDataFrame(rows, schema))
    assert sum("Window [" in line for line in _plan(ranked).splitlines()) <= 3
    for family in {r.family for r in ranked.collect()}:
        places = sorted(r.place for r in ranked.filter(F.col("family") == family).collect())
        assert places == list(range(1, len(places) + 1))


def test_fields_are_made_without_a_lambda_over_options(spark):
    rows = spark.createDataFrame([(1, 7, 245, "Main\nrest", 4), (2, 7, 999, "x", 0), (3, 7, 440, "s", None)], "pk int, fk_books int, fk_attriblist int, text string, nonfiling int")
    fields = marc_feed._attribute_fields(rows)
    assert "lambdafunction" not in _plan(fields)
    assert sorted((r.tag, len(r.subfields)) for r in fields.collect()) == [("245", 2), ("490", 1), ("830", 1)]


def test_buckets_follow_the_table(spark, monkeypatch):
    monkeypatch.setattr(stores, "BUCKET_KEYS", 10)
    assert stores._buckets(spark.range(1000)) == 100 and stores._buckets(spark.range(5)) == stores.BUCKETS


def test_touched_buckets_are_looked_up(spark, tmp_path):
    assert reconcile._marks([1, 3], 4) == [False, True, False, True]
    files = spark.createDataFrame([(i, f"{10 + i}/f.txt", 0) for i in range(40)], "id int, archive_path string, diskstatus int")
    full = lambda ids: spark.createDataFrame([(f"/p/files/{10 + i}/f.txt",) for i in ids], "full_path string")
    for buckets in (1, 64):
        store = BucketStore(spark, str(tmp_path / str(buckets)))
        first, _ = reconcile.audit_presence(files, full(range(39)), "/p", store, buckets)
        assert [r.id for r in first.collect()] == [39]
        second, touched = reconcile.audit_presence(files, full(range(38)), "/p", store, buckets)
        assert sorted(r.id for r in second.collect()) == [38, 39] and len(touched) == 1
