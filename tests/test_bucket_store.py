"""Bucketed tables under one manifest: plans without exchanges, untouched buckets, rival writers, versions."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from folioframe.plans import build, catalog_feed, marc_feed
from folioframe.sinks import snapshots
from folioframe.sinks.bucket_store import BucketStore, CommitConflict

ATTRIBUTES = "pk bigint, fk_books bigint, fk_attriblist int, text string, nonfiling int"
KEYS = {"v_books": "pk", "v_attributes": "fk_books", "v_book_terms": "fk_books", "v_book_authors": "fk_books", "v_files": "fk_books", "v_targets": "fk_books", "v_categories": "fk_books"}


def attributes(spark, n=200):
    return spark.createDataFrame([(10 * b + k, b, 520 if k else 245, f"text {b} {k}", 0) for b in range(n) for k in range(3)], ATTRIBUTES)


def made(spark, folder, rows, buckets=8):
    store = BucketStore(spark, str(folder))
    change = store.begin()
    change.create("attributes", rows, "fk_books", buckets)
    change.commit()
    return store


def texts(df):
    return sorted(tuple(r) for r in df.select("fk_books", "fk_attriblist", "text").collect())


def summary(spark, store, book, text):
    """A change, not yet committed, that sets the summary of one book."""
    change, new = store.begin(), spark.createDataFrame([(book, text)], "fk_books bigint, text string")
    whole = change.read("attributes")
    touched = change.rewrite("attributes", new.select("fk_books"), lambda rows: snapshots.upsert_attribute(rows, new, 520, whole))
    return change, touched


@pytest.fixture(scope="module")
def bucketed(spark, catalog, tmp_path_factory):
    store = BucketStore(spark, str(tmp_path_factory.mktemp("store")))
    change = store.begin()
    for name, key in KEYS.items():
        change.create(name, catalog[name], key, 8)
    change.commit()
    return {**{name: store.read(name) for name in KEYS}, "v_authors": catalog["v_authors"], "v_disk_listing": catalog["v_disk_listing"]}


FEEDS = {
    "catalog": lambda t, near: catalog_feed.catalog(t["v_books"], t["v_attributes"], t["v_book_terms"], t["v_book_authors"], t["v_authors"], **near),
    "marc": lambda t, near: marc_feed.marc_fields(t["v_books"], t["v_categories"], t["v_attributes"], t["v_book_authors"], t["v_authors"], t["v_book_terms"], "2001-11-05 00:00:00"),
    "plan": lambda t, near: build.build_plan(t["v_books"], t["v_categories"], t["v_files"], t["v_disk_listing"], t["v_targets"]),
}


@pytest.mark.parametrize("name", FEEDS)
def test_feeds_over_buckets_move_no_books(spark, catalog, bucketed, name):
    frame = FEEDS[name](bucketed, {"colocated": True} if name == "catalog" else {})
    rows = sorted(map(repr, frame.collect()))
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    dealt = [line for line in re.findall(r"Exchange hashpartitioning\(([^,]*)", plan)]
    assert not [d for d in dealt if d.startswith(("fk_books", "pk"))], dealt
    assert len(rows) > 100 and rows == sorted(map(repr, FEEDS[name]({n: catalog[n] for n in bucketed}, {}).collect()))


def test_a_change_writes_only_its_buckets(spark, tmp_path):
    store = made(spark, tmp_path, attributes(spark))
    before = store.manifest()["tables"]["attributes"]["generations"]
    old = store.read("attributes")
    change, touched = summary(spark, store, 7, "new")
    assert texts(store.read("attributes")) == texts(attributes(spark)) and change.commit() == 1
    after = store.manifest()["tables"]["attributes"]["generations"]
    assert len(touched) == 1 and {b for b in before if before[b] != after[b]} == {str(touched[0])}
    assert texts(store.read("attributes")) == sorted((b, c, "new" if (b, t) == (7, "text 7 1") else t) for b, c, t in texts(attributes(spark)))
    assert texts(old) == texts(store.read("attributes", 0)) == texts(attributes(spark))
    scanned = store.rows("attributes", store.manifest()).filter(F.col("_bucket") == touched[0])
    assert len(scanned.inputFiles()) == 1 and len(store.read("attributes").inputFiles()) == 8


def test_of_two_writers_the_second_gets_a_conflict(spark, tmp_path):
    store = made(spark, tmp_path, attributes(spark))
    (first, _), (second, _) = summary(spark, store, 7, "first"), summary(spark, BucketStore(spark, str(tmp_path)), 7, "second")
    first.commit()
    with pytest.raises(CommitConflict):
        second.commit()
    assert store.versions() == [0, 1] and (7, 520, "first") in texts(store.read("attributes"))
    assert not any("second" in t for *_, t in texts(store.read("attributes")))
    again, _ = summary(spark, store, 7, "second")
    assert again.commit() == 2 and (7, 520, "second") in texts(store.read("attributes"))


def test_one_of_many_racing_writers_wins(spark, tmp_path):
    store = made(spark, tmp_path, attributes(spark, 20))
    changes = [store.begin() for _ in range(6)]

    def commit(change):
        try:
            return change.commit()
        except CommitConflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        assert sorted(pool.map(commit, changes), key=str) == [1, None, None, None, None, None]


def test_new_rows_are_numbered_after_the_whole_table(spark, tmp_path):
    store = made(spark, tmp_path, attributes(spark, 50).filter("fk_attriblist = 245 OR fk_books = 49"))
    change, _ = summary(spark, store, 3, "added")
    change.commit()
    rows = store.read("attributes").filter("text = 'added'").collect()
    assert [(r.pk, r.fk_books, r.fk_attriblist) for r in rows] == [(493, 3, 520)]


def test_rows_outside_their_buckets_are_an_error(spark, tmp_path):
    store = made(spark, tmp_path, attributes(spark))
    change, book = store.begin(), spark.createDataFrame([(7,)], "fk_books bigint")
    with pytest.raises(Exception, match="outside the buckets"):
        change.rewrite("attributes", book, lambda rows: attributes(spark))
    assert store.versions() == [0] and texts(store.read("attributes")) == texts(attributes(spark))


def test_one_version_changes_all_tables(spark, tmp_path):
    store = made(spark, tmp_path, attributes(spark, 40))
    change = store.begin()
    change.create("books", spark.range(40).withColumnRenamed("id", "pk"), "pk", 4)
    change.commit()
    gone, change = spark.createDataFrame([(3,), (11,), (999,)], "pk int"), store.begin()
    change.rewrite("attributes", gone, lambda rows: snapshots.forget_books({"t": (rows, "fk_books")}, gone)["t"])
    change.rewrite("books", gone, lambda rows: snapshots.forget_books({"t": (rows, "pk")}, gone)["t"])
    assert store.read("books").count() == 40
    change.commit()
    left = set(range(40)) - {3, 11}
    assert {r.pk for r in store.read("books").collect()} == {b for b, *_ in texts(store.read("attributes"))} == left
    assert store.read("books", 1).count() == 40 and "books" not in store.manifest(0)["tables"]


def test_empty_tables_keys_and_vacuum(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path))
    assert store.versions() == [] and store.manifest()["tables"] == {}
    change = store.begin()
    change.create("attributes", attributes(spark).limit(0), "fk_books", 4)
    change.commit()
    assert store.read("attributes").count() == 0 and store.read("attributes").columns == ["pk", "fk_books", "fk_attriblist", "text", "nonfiling"]
    change = store.begin()
    none = spark.createDataFrame([], "fk_books bigint")
    assert change.rewrite("attributes", none, lambda rows: rows) == []
    change.create("attributes", attributes(spark, 30).unionByName(spark.createDataFrame([(1, None, 1, None, None)], ATTRIBUTES)), "fk_books", 4)
    change.commit()
    change, _ = summary(spark, store, 7, "new")
    change.commit()
    rows = texts(store.read("attributes").na.fill("-").na.fill(-1))
    assert len(rows) == 91 and rows[0] == (-1, 1, "-")
    store.vacuum()
    fresh = BucketStore(spark, str(tmp_path))
    assert fresh.versions() == [2] and texts(fresh.read("attributes").na.fill("-").na.fill(-1)) == rows
    used = set(fresh.manifest()["tables"]["attributes"]["generations"].values())
    assert {p.name for p in (tmp_path / "data").iterdir()} == used and len(used) == 2


def test_a_snapshot_is_not_overwritten_by_a_rival(spark, tmp_path):
    one, two = (snapshots.SnapshotTable(spark, str(tmp_path)) for _ in range(2))
    one.replace(spark.range(3))
    versions = two._versions()
    two._versions = lambda: versions
    one.replace(spark.range(5))
    with pytest.raises(CommitConflict):
        two.replace(spark.range(7))
    assert one.read().count() == 5 and sorted(p.name for p in tmp_path.iterdir()) == ["v-0", "v-1"]
