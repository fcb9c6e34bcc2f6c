"""Ranks, places and runs against brute force, with limits small enough that hot paths are taken."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from folioframe.fixed_values import BUILD_ORDER, EXCLUSION_GLOBS, SOURCE_FAMILIES
from folioframe.functions.globs import glob_to_regex
from folioframe.operators import lists, ranking
from folioframe.operators.candidates import best_sources, candidates, rank_candidates


@pytest.mark.parametrize("slice_rows", [100_000, 100, 20, 3, 1])
def test_hot_groups_rank_like_a_window(spark, slice_rows):
    rng = random.Random(7)
    rows = [("hot" if i % 3 else f"k{i % 17}", rng.choice([None, rng.randint(0, 5)]), i) for i in range(900)] + [(None, 1, 900), (None, 2, 901)]
    frame = spark.createDataFrame(rows, "k string, v int, id int")
    key = ranking.order_key([(F.col("v"), True, True)], F.col("id"))
    ranked = ranking.skew_safe_rank(frame, ["k"], key, "rn", slice_rows)
    window = Window.partitionBy("k").orderBy(F.desc_nulls_first("v"), "id")
    expected = frame.withColumn("rn", F.row_number().over(window))
    assert sorted(map(tuple, ranked.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def runs(ids):
    out = []
    for i in sorted(set(ids)):
        if out and out[-1][1] + 1 == i:
            out[-1][1] = i
        else:
            out.append([i, i])
    return [tuple(r) for r in out]


CASES = {
    "dense": range(0, 400),
    "edges": [0, 7, 8, 15, 16, 17, 63, 64, 65, 66, 127, 128],
    "random": random.Random(3).sample(range(1000), 500),
    "far": [1, 2, 3, 10**12, 10**12 + 1, 10**15],
    "single": [5],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("bits", [3, 20])
def test_islands(spark, case, bits):
    ids = list(CASES[case])
    frame = spark.createDataFrame([(i,) for i in ids + ids[:3]], "pk bigint")
    found = ranking.islands_of_ids(frame, "pk", bits).orderBy("first_id").collect()
    assert [(r.first_id, r.last_id) for r in found] == runs(ids)
    again = []
    for row in found:
        for part in row.text.split():
            ends = part.split("-")
            again += range(int(ends[0]), int(ends[-1]) + 1) if len(ends) == 2 else [int(part)]
        assert ("-" in row.text) == (row.n_ids > 2)
    assert again == sorted(set(ids))


@pytest.mark.parametrize("case", CASES)
def test_places_and_chunks(spark, case):
    ids = sorted(set(CASES[case]))
    frame = spark.createDataFrame([(i,) for i in ids], "pk bigint")
    assert {r.pk: r.place for r in ranking.number_ids(frame, "pk", "place").collect()} == {pk: i for i, pk in enumerate(ids)}
    assert {r.pk: r.chunk for r in ranking.chunk_ids(frame, "pk", 7).collect()} == {pk: i // 7 for i, pk in enumerate(ids)}


def test_lists_over_many_slices(spark):
    rows = [("hot", i, f"v{i}") for i in range(3500)] + [("small", 2, "b"), ("small", 1, "a")]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, pos int, v string")
    found = {r.k: r.l for r in lists.ordered_list(frame, ["k"], "pos", "v", "l").collect()}
    assert found == {"hot": "; ".join(f"v{i}" for i in range(3500)), "small": "a; b"}


def test_types_are_planned_independently():
    """A finished output is offered to later types as `<type>/unknown`; no preference list takes it."""
    import re

    made = [f"{t}/unknown" for t, _ in BUILD_ORDER]
    every = {g for globs in SOURCE_FAMILIES.values() for g in globs} | {g for globs in EXCLUSION_GLOBS.values() for g in globs}
    assert not [(m, g) for m in made for g in every if re.match(glob_to_regex(g), m)]


FILES = [  # id, book, path, type, encoding, day, extent
    (1, 9846, "9/8/4/9846/9846.txt", "txt", "us-ascii", "2005-01-01", 10),
    (2, 9846, "9/8/4/9846/9846-8.txt", "txt", "iso-8859-1", "2005-01-01", 10),
    (3, 9846, "9/8/4/9846/9846-h/9846-h.htm", "html", "iso-8859-1", "2005-01-01", 10),
    (4, 9846, "9/8/4/9846/9846-h/other.htm", "html", None, "2006-01-01", 10),
    (5, 64156, "6/4/1/5/64156/glossary.htm", "html", "utf-8", "2020-01-01", 10),
    (6, 64156, "6/4/1/5/64156/64156-0.txt", "txt", "utf-8", "2020-01-01", 10),
    (7, 64156, "6/4/1/5/64156/64156-1.txt", "txt", "utf-8", "2021-01-01", 10),
    (8, 64156, "6/4/1/5/64156/64156-2.txt", "txt", "utf-8", None, 10),
]


def files(spark):
    rows = [(*r[:5], *r[5:], "none", 0, 0, False) for r in FILES]
    frame = spark.createDataFrame(
        rows,
        "id bigint, fk_books bigint, archive_path string, fk_filetypes string, fk_encodings string, modified string, extent bigint, compression string, diskstatus int, obsoleted int, generated boolean",
    )
    return frame.withColumn("modified", F.to_timestamp("modified").cast("timestamp_ntz"))


def test_best_source_of_a_book(spark):
    best = {r.fk_books: r for r in best_sources(candidates(files(spark))).collect()}
    assert best[9846].html_first.archive_path == "files/9846/9846-h/9846-h.htm"
    assert best[9846].text_first.id == 2
    assert best[64156].html_first.id == 8  # the side page does not count; undated files sort first
    assert best[64156].rst_only is None


def test_ranks_agree_with_picks(spark):
    cands = candidates(files(spark))
    ranked = rank_candidates(cands).orderBy("fk_books", "family", "place").collect()
    order = [r.id for r in ranked if r.fk_books == 64156 and r.family == "any"]
    assert order == [8, 7, 6]
    assert [r.id for r in ranked if r.fk_books == 9846 and r.family == "html_first"] == [3, 4, 2, 1]


def test_full_lists_hold_on_whole_tables(spark, catalog):
    cands = candidates(catalog["v_files"])
    first = rank_candidates(cands).filter("place = 1").select("fk_books", "family", F.struct("archive_path", "extent").alias("top"))
    best = best_sources(cands)
    options = F.array(*[F.struct(F.lit(f).alias("family"), F.col(f).alias("pick")) for f in SOURCE_FAMILIES])
    picks = best.select("fk_books", F.inline(options)).filter("pick IS NOT NULL")
    both = picks.join(first, ["fk_books", "family"], "full_outer")
    assert both.filter("pick IS NULL OR top IS NULL OR pick.archive_path <> top.archive_path OR pick.extent <> top.extent").count() == 0
