"""Streams batch by batch: settled hours, deletions, late submissions, pruned posts, late rows as Spark counts them."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from folioframe.streaming import changes, spools
from folioframe.streaming.progress import stream_totals
from folioframe.streaming.runner import drain_to_files
from folioframe.streaming.state import rocksdb_state

DAY = datetime(2024, 1, 1)


def at(hours, minutes=0):
    return DAY + timedelta(hours=hours, minutes=minutes)


class Landing:
    """A folder that rows are put into batch by batch, read as a stream."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, str(folder), schema
        spark.createDataFrame([], schema).write.parquet(self.folder)

    def put(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.folder)


CHANGE = "book bigint, time timestamp"


def rebuilds(spark, land, out, batches):
    for rows in batches:
        land.put(rows)
        with rocksdb_state(spark):
            found = drain_to_files(changes.settled_rebuilds(land.stream()), str(out))
    return sorted((r.book, r["first"], r["last"], r.n_changes) for r in found.collect())


def test_two_changes_over_the_full_hour_are_one_rebuild(spark, tmp_path):
    land = Landing(spark, tmp_path / "in", CHANGE)
    rows = [(1, at(10, 59)), (1, at(11, 1)), (1, at(11, 59)), (2, at(11, 1)), (None, at(11))]
    assert rebuilds(spark, land, tmp_path / "out", [rows, [(3, at(20))]]) == [
        (1, at(10, 59), at(11, 1), 2), (1, at(11, 59), at(11, 59), 1), (2, at(11, 1), at(11, 1), 1),
    ]
    land = Landing(spark, tmp_path / "once-in", CHANGE)
    land.put(rows[:2])
    assert drain_to_files(changes.rebuilds_at_once(land.stream()), str(tmp_path / "once")).count() == 1


def greedy(rows, mark):
    out, times = [], {}
    for book, time in rows:
        times.setdefault(book, []).append(time)
    for book, seen in times.items():
        seen.sort()
        while seen:
            hour = [t for t in seen if t < seen[0] + timedelta(hours=1)]
            if seen[0] + timedelta(hours=1) <= mark:
                out.append((book, hour[0], hour[-1], len(hour)))
            seen = seen[len(hour) :]
    return sorted(out)


@pytest.mark.parametrize("size", [400, 60])
def test_hours_do_not_depend_on_batches(spark, tmp_path, size):
    """Changes out of order, within the watermark, over restarts give the hours of the sorted changes."""
    rng = random.Random(3)
    rows = [(rng.randint(1, 5), at(k / 20, rng.randint(0, 25))) for k in range(400)]
    batches = [rows[k : k + size] for k in range(0, 400, size)]
    assert rebuilds(spark, Landing(spark, tmp_path / "in", CHANGE), tmp_path / "out", batches) == greedy(rows, max(t for _, t in rows) - timedelta(hours=1))


MAIL = "seq bigint, ebook string, role string, email string, deleted boolean"


def test_a_deleted_address_goes_and_stays_away(spark, tmp_path):
    land, out = Landing(spark, tmp_path / "in", MAIL), str(tmp_path / "out")
    sent, current = [], lambda: {(r.ebook, r.role): r.email for r in spools.current_addresses(spark, out).collect()}

    def batch(rows):
        land.put(rows)
        sent.extend(rows)
        spools.latest_addresses(land.stream(), out)
        latest = {}
        for seq, ebook, role, email, deleted in sorted(sent, key=lambda r: r[0]):
            if ebook.isdigit() and (deleted or email):
                latest[int(ebook), role] = None if deleted else email
        assert current() == {k: v for k, v in latest.items() if v}

    batch([(1, "7", "ww", "a@x.org", None), (2, "7", "notify", "b@x.org", False), (3, "8", "ww", "c@x.org", None), (4, "no", "ww", "d@x.org", None)])
    batch([(6, "7", "ww", None, True), (9, "8", "ww", "e@x.org", False)])
    assert current() == {(7, "notify"): "b@x.org", (8, "ww"): "e@x.org"}
    batch([(5, "7", "ww", "old@x.org", False), (8, "8", "ww", None, True), (10, "8", "ww", None, None)])
    assert current() == {(7, "notify"): "b@x.org", (8, "ww"): "e@x.org"}
    batch([(12, "7", "ww", "new@x.org", False), (11, "8", "ww", None, True)])
    assert current() == {(7, "notify"): "b@x.org", (7, "ww"): "new@x.org"}


def test_late_submissions_fill_triggers_and_others_come_out_alone(spark, tmp_path):
    triggers = Landing(spark, tmp_path / "trig", "id bigint, ebook bigint, time timestamp")
    records = Landing(spark, tmp_path / "subs", "seq bigint, ebook bigint, time timestamp, valid boolean, title string, credit string")
    shown = lambda pairs: {r.id: r.title for r in spools.best_submissions(pairs).collect()}

    def drain():
        return drain_to_files(spools.with_submissions(triggers.stream(), records.stream()), str(tmp_path / "out"))

    triggers.put([(1, 7, at(1)), (2, 8, at(1)), (3, 7, at(30))])
    records.put([(1, 7, at(2), False, None, None)])
    assert shown(drain()) == {1: None}
    triggers.put([(4, 10, at(31))])
    records.put([(2, 7, at(12), True, "late but in time", "c"), (3, 7, at(14), True, "too late for 1", "c"), (4, 9, at(30), True, "no trigger", "c")])
    assert shown(drain()) == {1: "late but in time", 2: None}
    triggers.put([(5, 11, at(60))])
    records.put([(5, 7, at(40), True, "for 3", "c"), (6, 7, at(41), False, "unreadable", "c"), (7, 12, at(60), True, "moves the time on", "c")])
    assert shown(drain()) == {1: "late but in time", 2: None, 3: "for 3", 4: None}
    alone = drain().filter("seq IS NULL").collect()
    assert sorted((r.id, r.arrived) for r in alone) == [(2, None), (4, None)]


def test_a_batch_reads_the_posts_of_its_buckets_only(spark, tmp_path):
    schema = "fk_books bigint, media string, time timestamp"
    land, out = Landing(spark, tmp_path / "in", schema), str(tmp_path / "out")
    none = spark.createDataFrame([], schema)
    for rows in ([(b, "Bluesky", DAY) for b in range(500)], [(7, "Bluesky", DAY), (900, "Bluesky", DAY), (900, "Bluesky", DAY), (-1, "Bluesky", DAY)]):
        land.put(rows)
        spools.post_once(land.stream(), none, out)
    posted = spark.read.parquet(f"{out}/rows").select("fk_books", "n").collect()
    assert sorted(map(tuple, posted)) == sorted([(b, 0) for b in range(500)] + [(900, 1), (-1, 1)])
    keys = spark.read.schema("fk_books BIGINT, media STRING, bucket INT").parquet(f"{out}/arrived/n=1")
    seen = spools._posts_seen(spark, out, keys, 1)
    assert [r.fk_books for r in seen.collect()] == [7]
    plan = seen._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    scans = [p for p in _nodes(plan.executedPlan()) if p.nodeName().startswith("Scan parquet") and "dynamicpruning" in p.toString()]
    read = [p.metrics().apply("numFiles").value() for p in scans]
    assert 1 <= read[0] <= 3 < len(spark.read.parquet(f"{out}/rows").inputFiles())


def _nodes(plan):
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        out.append(node)
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
    return out


def test_late_rows_are_those_spark_drops(spark, tmp_path):
    rng = random.Random(5)
    land = Landing(spark, tmp_path / "in", "id bigint, time timestamp, kind string")
    late, kept, total = str(tmp_path / "late"), str(tmp_path / "kept"), 0
    dropped = observed = 0
    for batch in range(4):
        rows = [(1000 * batch + k, at(3 * batch - rng.choice([0, 0, 1, 4, 9]), rng.randint(0, 50)), "x") for k in range(100)]
        total += len(rows)
        land.put(rows)
        with stream_totals(spark) as split:
            changes.split_late(land.stream(), late)
        with stream_totals(spark) as dropping:
            drain_to_files(changes.on_time(land.stream()), kept)
        observed += split.observed["changes.n"]
        dropped += dropping.dropped
    marked = {r.kept_as: r["count"] for r in spark.read.parquet(f"{late}/rows").groupBy("kept_as").count().collect()}
    assert marked["late"] == dropped > 20 and observed == total == sum(marked.values())
    on_time = {r.id for r in spark.read.parquet(f"{late}/rows").filter(F.col("kept_as") == "on_time").collect()}
    assert {r.id for r in spark.read.parquet(f"{kept}/rows").collect()} == on_time
