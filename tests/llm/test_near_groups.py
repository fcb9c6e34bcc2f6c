"""Groups of near copies in which few pairs link: the pairs that are compared, and what a written step leaves behind."""

from __future__ import annotations

import random
from pathlib import Path

from pyspark.sql import functions as F

from folioframe.llm import jaccard_join
from folioframe.llm.common import staged


def test_group_is_joined_by_fewer_pairs_than_link(spark, monkeypatch):
    rng, base = random.Random(7), [f"w{k}" for k in range(60)]
    texts = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(60)] = f"new{i}"
        texts.append(" ".join(words))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root, linked = list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                linked += 1
                a, b = sorted((root[i], root[j]))
                if a != b:
                    root = [a if x == b else x for x in root]
    met, plain = [], jaccard_join.links
    monkeypatch.setattr(jaccard_join, "links", lambda pairs, *more: met.append(pairs.count()) or plain(pairs, *more))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert found == dict(enumerate(root))
    assert sum(met) < 0.7 * linked, (met, linked)


def test_written_step_leaves_no_shuffle_files(spark):
    roots = [Path(d.getPath()) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for root in roots for f in root.glob("*/shuffle_*.data")}
    before = files()
    rows = staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test-step")
    assert not files() - before
    assert rows.count() == 7


def test_wide_parity_only_where_the_short_one_says_less(spark):
    docs = spark.createDataFrame([(1, " ".join(f"a{k}" for k in range(200))), (2, " ".join(f"b{k}" for k in range(3000)))], "doc_id bigint, text string")
    sizes = {r.doc_id: (len(r.short), len(r.wide)) for r in jaccard_join.described(docs).collect()}
    assert sizes == {1: (16, 0), 2: (16, 64)}
