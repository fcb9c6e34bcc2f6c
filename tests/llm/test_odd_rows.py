"""Every operator on odd rows, on an empty table and with clashing extra columns."""

import pytest
from cases import collected, documents, rows
from pyspark.sql import functions as F

import corpus_pipeline
from folioframe.llm import context_mixing, decontamination, embedding_dedup, jaccard_join, language_id, line_dedup, personal_data, quality, token_counts, unigram_pieces


def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(40)] + [(200, 0, 0), (9999, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")


def items(spark):
    return spark.createDataFrame([(1, " ".join(rows()[0][1].split()[:40])), (2, "too short"), (3, None), (4, ""), (1, " ".join(rows()[0][1].split()[:40]))], "item_id bigint, text string")


OPERATORS = {
    "op1": lambda s, d: context_mixing.score_texts(d, context_mixing.learn_model(d)),
    "op2": lambda s, d: language_id.predict_languages(d, language_id.learn_languages(d)),
    "op3": lambda s, d: decontamination.find_leaks(d, items(s)),
    "op3_without": lambda s, d: decontamination.without_leaks(d, items(s)).select("doc_id", "text"),
    "op4": lambda s, d: jaccard_join.jaccard_components(d),
    "op4_one": lambda s, d: jaccard_join.one_of_each(d).select("doc_id", "text"),
    "op5": lambda s, d: line_dedup.drop_boilerplate(d, counts=True).select("doc_id", "text", "n_lines", "n_dropped"),
    "op7": lambda s, d: unigram_pieces.digest(d),
    "op7_decode": lambda s, d: unigram_pieces.decode(unigram_pieces.encode(d)).select("doc_id", "piece_ids", "decoded"),
    "op8": lambda s, d: token_counts.count_tokens(d),
    "op9": lambda s, d: personal_data.find_personal_data(d),
    "op10": lambda s, d: quality.predict_quality(d, labels(s)),
}
FEWER = {"op3", "op3_without", "op4_one"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_extra_columns(spark, name):
    plain = collected(OPERATORS[name](spark, documents(spark)))
    assert plain == collected(OPERATORS[name](spark, documents(spark, extra=True).repartition(3)))
    assert len(plain) == len(rows()) or name in FEWER
    none = OPERATORS[name](spark, documents(spark, []))
    assert none.count() == 0 and none.columns


def test_one_of_each_keeps_a_document_of_every_group(spark):
    kept = [r.doc_id for r in jaccard_join.one_of_each(documents(spark)).collect()]
    assert kept.count(3) == 1 and kept.count(None) == 2 and 100 not in kept and {200, 201, 202, 203} <= set(kept)


def test_leak_is_found_in_every_copy(spark):
    found = {(r.doc_id, r.item_id, r.containment) for r in decontamination.find_leaks(documents(spark), items(spark)).collect()}
    assert found == {(0, 1, 1.0), (100, 1, 1.0)}


VECTORS = [
    (1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 2), (4, [0.0, 0.0, 0.0], 1), (5, None, 1), (6, [1.0, None, 0.0], 1),
    (7, [float("nan"), 0.0, 1.0], 1), (8, [1.0, 0.1, 0.0], 1), (9, [1.0, 0.0, 0.0], None), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [], 1), (None, [1.0, 0.0, 0.0], 1), (13, [0.0, 1.0, 0.0], 1),
]


def test_vectors(spark):
    df = spark.createDataFrame(VECTORS, "vec_id bigint, embedding array<double>, label int").withColumn("node", F.lit(1)).withColumn("shard", F.lit(1))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_copies(df, shard=2).collect()}
    assert {k: v for k, v in found.items() if v[0]} == {1: (3, 1, True), 2: (3, 1, False), 8: (3, 1, False), 10: (3, 1, False)}
    assert all(found[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 9, 11, 12, 13)) and found[None] == (0, None, True)
    assert embedding_dedup.near_copies(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e308, 5e-324 * 2**20])
def test_vectors_of_any_magnitude(spark, size):
    rows = [(1, [size, 0.0, size / 8], 1), (2, [size, size / 16, size / 8], 1), (3, [0.0, size, 0.0], 1), (4, [1.0, 0.0, 0.125], 1), (5, [size, 0.0, size / 8], 1)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_copies(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    assert found == {1: (3, 1), 2: (3, 1), 3: (0, 3), 4: (3, 1), 5: (3, 1)}


def test_stages_keep_columns_and_stand_empty_tables(spark, tmp_path):
    folder = str(tmp_path / "tables")
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    items(spark).write.parquet(f"{folder}/benchmark.parquet")
    for docs in (documents(spark, extra=True), documents(spark, [])):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.staged(stage(spark, docs, folder), name)
            assert docs.columns == columns
        last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
        assert last.columns[: len(columns)] == columns and last.filter("NOT restored").filter("doc_id <> 204").count() == 0
