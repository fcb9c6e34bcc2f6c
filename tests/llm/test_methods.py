"""Each operator beside brute force, the tokenizer's library, or held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import documents, junk, prose

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from folioframe.llm import context_mixing, embedding_dedup, jaccard_join, language_id, personal_data, quality, token_counts, unigram_pieces
from folioframe.llm.common import hashed, table

SMALL = "/root/testdata/sf0.01"
PIECES = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "é", "1", "23", "!!", "***", "日本", "벨", "😀", "<s>", "</s>", "$", "   ", ".", " .", "\n\n", "ß", "-", "x" * 40, "y" * 130]


def strings(n: int, extra: tuple = ()) -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choice([*PIECES, *extra]) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def library(kind: int | None = None):
    import public_tokenizers
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    path = public_tokenizers.path("piece_bpe_32k.model")
    if kind is None:
        return sentencepiece.SentencePieceProcessor(model_file=path)
    model = proto.ModelProto()
    model.ParseFromString(open(path, "rb").read())
    model.trainer_spec.model_type = kind
    return sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_token_counts_equal_the_library():
    machine, lib = token_counts.transducer(None), library()
    for text in strings(3000, ("▁", "▁▁")) + [" " * n for n in range(200)]:
        assert machine.count(text) == len(lib.encode(text))
        assert not text or machine.scan(text.replace("▁", " "), 3) == len(lib.encode(text))


def test_chunk_maps_compose_in_any_grouping():
    machine, text = token_counts.transducer(None), " " + prose(3, 60) + "   " + prose(4, 20)
    maps = [machine.chunk(text[k : k + 7]) for k in range(0, len(text), 7)]
    left = maps[0]
    for m in maps[1:]:
        left = machine.compose(left, m)
    right = maps[-1]
    for m in maps[-2::-1]:
        right = machine.compose(m, right)
    assert left == right


def test_viterbi_equals_the_library_as_unigram_model():
    model, lib = unigram_pieces.load_pieces(), library(1)
    texts = [t for t in strings(400) if t]
    ids, offsets = unigram_pieces.encode_batch(model, pa.array(texts))
    for k, text in enumerate(texts):
        own = ids[offsets[k] : offsets[k + 1]].tolist()
        best = lib.nbest_encode(text, nbest_size=2)[0]
        assert own == best or sum(model.score[own]) >= sum(model.score[best])
    assert unigram_pieces.decode_batch(model, ids, offsets) == texts


def test_long_segments_take_the_same_path():
    model = unigram_pieces.load_pieces()
    for word in ("x" * 60, "thereintheé日😀" * 3, "abc" * 20):
        raw = ("▁" + word).encode()
        ids, _ = unigram_pieces.segment_ids(model, pa.array([word]))
        assert unigram_pieces.long_path(model, raw).tolist() == ids.tolist()


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def matches(text: str) -> list:
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True, "card": 14 <= len(digits) <= 19 and personal_data.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), m.end(), kind))
    return personal_data.ordered(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    alphabet = [*"a@.+-0123456789 ()é%_", "1.2.3.4", "4845168114407329", "a@b.c", "+1 (017) 555-7713", "\n"]
    for _ in range(8000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert personal_data.base_spans(text) == matches(text), text


def test_field_adds_what_patterns_miss(spark):
    model = personal_data.fit_field(table(spark, SMALL, "documents"))
    found = lambda t: [(t[s:e], k) for s, e, k in personal_data.ordered(model.added(t, personal_data.base_spans(t)))]
    assert found("pay 4845168114407329 4524132264652876 now") == [("4845168114407329", "card"), ("4524132264652876", "card")]
    assert found("pay 4845168114407329 9807915762804490 now") == [("4845168114407329", "card")]
    assert found("write john dot smith at mail dot example dot com") == [("john dot smith at mail dot example dot com", "email")]
    assert found("we were at home. The dot is here") == [] and found("in 2019 there were 300 of 4000") == []


@pytest.mark.parametrize("width", [6, 40])
def test_jaccard_components_equal_brute_force(spark, width):
    rng, texts = random.Random(width), []
    for _ in range(60):
        base = [rng.choice("abcdefgh") + str(rng.randint(0, 30)) for _ in range(rng.randint(1, width))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            if rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = "new" + str(rng.randint(0, 3))
            texts.append(" ".join(copy))
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)})
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df).collect()}
    assert found == {i: (len(sets[i]), root[i]) for i in range(len(texts))}


def test_subset_keys_meet_for_every_link():
    for n in range(1, 13):
        for m in range(n, 13):
            for shared in range(n + 1):
                if 100 * shared >= 80 * (n + m - shared):
                    assert jaccard_join.needed(n, m) <= shared
                    assert jaccard_join.needed(n, m) in set(jaccard_join.subset_sizes(n, 12)) & set(jaccard_join.subset_sizes(m, 12))


@pytest.mark.parametrize("shard", [8192, 60])
def test_graph_search_recall(spark, shard):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    x = np.concatenate([centres[rng.integers(0, 40, 300)] + 0.15 * rng.normal(size=(300, 16)), rng.normal(size=(100, 16)), centres[:1].repeat(30, 0)])
    label = rng.integers(0, 2, len(x))
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))], "vec_id bigint, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_copies(df, shard=shard).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = ((unit @ unit.T >= 0.93) & (label[:, None] == label)).sum(axis=1) - 1
    assert all(found[i] <= t for i, t in enumerate(true)) and sum(found.values()) >= 0.9 * true.sum() > 0


def test_quality_on_held_out_rows(spark):
    rows = [(i, prose(i, 80) if i % 4 else junk(i, 80), "en", "s", 100) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(400)], "doc_id bigint, quality int")
    found = [r for r in quality.predict_quality(documents(spark, rows), labels).collect() if r.held_out]
    assert len(found) > 40 and sum(r.predicted == int(r.doc_id % 4 > 0) for r in found) / len(found) > 0.95


def test_factor_sum_of_squares_identity():
    rng = np.random.default_rng(2)
    model = quality.Machine(0.1, np.zeros(2), np.ones(2), rng.normal(size=2 + quality.BUCKETS), rng.normal(size=(2 + quality.BUCKETS, 3)))
    x, bucket, value = np.array([[0.5, -1.0]]), np.array([3, 9]), np.array([0.2, 0.7])
    vector, index = np.array([0.5, -1.0, 0.2, 0.7]), np.array([0, 1, 5, 11])
    plain = 0.1 + vector @ model.weight[index] + sum(vector[i] * vector[j] * (model.factor[index[i]] @ model.factor[index[j]]) for i in range(4) for j in range(i))
    assert math.isclose(model.margin(x, np.zeros(2, np.int64), bucket, value)[0][0], plain)


def test_language_on_held_out_rows(spark):
    found = {r.doc_id: r for r in queries()["op2_language_id"](spark, SMALL).collect()}
    truth = {r.doc_id: r.lang for r in table(spark, SMALL, "documents").select("doc_id", "lang").collect()}
    held = [i for i, r in found.items() if r.held_out]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in found)
    assert sum(found[i].lang_pred == truth[i] for i in held) / len(held) > 0.97


def test_model_scores(spark):
    docs = table(spark, SMALL, "documents")
    words = {r.doc_id: [*(r.text or "").encode().lower().split(), b" "] for r in docs.select("doc_id", "text").collect()}
    train = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(train.values()), len(train)
    found = queries()["op1_context_mixing"](spark, SMALL).collect()
    for r in found:
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words[r.doc_id])
        assert math.isclose(r.base_score, base, abs_tol=1e-6) and r.train_tokens == n and r.n_tokens == len(words[r.doc_id])
        assert r.n_known == sum(train[w] > 0 for w in words[r.doc_id]) and r.score < 0
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_known_words_share_one_probability():
    """Along the bits of the hashes of known words, the probabilities of all of them make one."""
    words = pa.array([f"w{k}" for k in range(50)])
    keys = np.sort(hashed(words))
    counts = np.arange(1, 101, dtype=float).reshape(50, 2)
    top, types = np.array([counts.sum(axis=0)]), np.array([50.0])
    mixer, total = context_mixing.Mixer.fresh([0.3, 0.7, 0.1]), np.zeros(50)
    for rows, inputs, gate, bit in context_mixing.known_bits(keys, counts, top, types, 0, False):
        total[rows] += np.log(mixer.predict(inputs, gate, bit))
    assert math.isclose(np.exp(total).sum(), 1.0, rel_tol=1e-9)


def test_pipeline_stages_against_plain_versions(spark):
    docs = table(spark, SMALL, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(corpus_pipeline.staged(stage(spark, frames[-1], SMALL), name))
    kept = [{r.doc_id: r.text for r in f.select("doc_id", "text").collect()} for f in frames]
    labels = {r.doc_id: r.quality for r in table(spark, SMALL, "labels").collect()}
    assert sum(labels.get(i) == 1 for i in kept[0]) == sum(labels.get(i) == 1 for i in kept[1])
    assert sum(labels.get(i) == 0 for i in kept[1]) <= 3 and kept[2].keys() == kept[1].keys()
    sets = {}
    for i, t in kept[2].items():
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    linked = lambda a, b: 100 * len(a & b) >= 80 * (len(a) + len(b) - len(a & b))
    ids = sorted(kept[3])
    assert not any(linked(sets[a], sets[b]) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b])
    gone = kept[2].keys() - kept[3].keys()
    assert gone and all(any(linked(sets[i], sets[j]) for j in kept[2] if j != i and sets[j]) for i in gone)
    items = [r.text.lower().split() for r in table(spark, SMALL, "benchmark").collect()]
    shingles = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in items]
    leaks = {i for i in kept[3] if any(len(s & sets[i]) >= 0.8 * len(s) for s in shingles)}
    assert kept[4].keys() == kept[3].keys() - leaks and leaks
    assert kept[5].keys() == kept[4].keys() and frames[5].filter("NOT restored").count() == 0


@pytest.mark.parametrize("key", ["op3_decontamination", "op4_jaccard_join", "op5_line_dedup"])
def test_query_equals_sql(spark, key):
    from check import compare

    total, _, problem = compare(spark, queries(), oracle_sql(), key, "0.001")
    assert not problem, problem


@pytest.mark.parametrize("edited", [False, True])
def test_pipeline_keeps_one_of_a_large_group_of_copies(spark, edited):
    """A group of copies that is over a tenth of its source does not make its own lines boilerplate."""
    body = [prose(k, 30) for k in range(500, 510)]
    notice = "share this page with your friends"
    rows = [(i, "\n".join([prose(1000 + i, 40), notice, prose(2000 + i, 40)]) if i % 4 == 0 else prose(i, 80), "en", "s", 100) for i in range(40)]
    copies = [[*body[:k], body[k] + " new", *body[k + 1 :]] if edited else body for k in range(8)]
    rows += [(100 + k, "\n".join(lines), "en", "s", 100) for k, lines in enumerate(copies)]
    docs = documents(spark, rows)
    cleaned = corpus_pipeline.staged(corpus_pipeline.line_dedup(spark, docs, SMALL), "cleaned")
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert texts == {r[0]: r[1].replace(notice + "\n", "") for r in rows}
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, cleaned, SMALL).collect()}
    assert kept == {*range(40), 100}


def test_footer_goes_from_a_site_that_is_mostly_copies(spark):
    """450 near copies of one page and 50 pages, 20 with a footer: the footer goes, the copies and all else stay."""
    body = [prose(k, 30) for k in range(500, 510)]
    copies = [(1000 + k, "\n".join([*body[: k % 10], body[k % 10] + f" edit {k}", *body[k % 10 + 1 :]]), "en", "s", 1) for k in range(450)]
    pages = [(k, "\n".join([prose(k, 40), prose(9000 + k, 40), *(["all pages of the club"] if k < 20 else [])]), "en", "s", 1) for k in range(50)]
    found = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, documents(spark, copies + pages), SMALL).collect()}
    assert found == {i: t.replace("\nall pages of the club", "") for i, t, *_ in copies + pages}


def test_groups_below_the_ratio_stay_when_larger_ones_are_counted_once(spark):
    """Once 300 copies are one page, 20 copies of another are over a tenth of the site; they are found in the next round."""
    page = lambda a: "\n".join(prose(k, 30) for k in range(a, a + 8))
    rows = [(k, page(100), "en", "s", 1) for k in range(300)] + [(400 + k, page(200), "en", "s", 1) for k in range(20)]
    rows += [(500 + k, page(1000 + 10 * k) + "\nfoot", "en", "s", 1) for k in range(30)]
    found = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, documents(spark, rows), SMALL).collect()}
    assert found == {i: t.removesuffix("\nfoot") for i, t, *_ in rows}


def test_line_dedup_runs_no_python(spark):
    docs = table(spark, SMALL, "documents")
    from folioframe.llm.line_dedup import boilerplate_of_copies

    for frame in (boilerplate_of_copies(docs, "source", "text", 0.1, 5), corpus_pipeline.line_dedup(spark, docs, SMALL)):
        assert not re.search("Python|Arrow|Pandas", frame._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("parts", [1, 4])
def test_large_group_of_near_copies_is_one_component(spark, parts):
    """Copies that are each a few edits from a common text, so that many pairs do not link directly."""
    rng = random.Random(7)
    base = prose(70, 120).split()
    texts = []
    for _ in range(300):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(120)] = f"new{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    texts += [prose(900 + k, 60) for k in range(100)]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if 100 * shared >= 80 * (len(a) + len(sets[j]) - shared):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(parts)
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert found == {i: top(i) for i in range(len(texts))}


@pytest.mark.parametrize("copies", [0, 40])
def test_audit_needs_links_to_pass(copies):
    """Beams on a graph without edges find next to nothing; neither few links nor long lists let the audit pass."""
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    vectors = unit(rng.normal(size=(1200, 32)))
    if copies:
        vectors = unit(vectors[:30].repeat(copies, 0) + 0.005 * rng.normal(size=(1200, 32)))
    queries = vectors if copies else unit(rng.normal(size=(1200, 32)))
    queries[700:703] = vectors[10:13]
    layers = [(np.arange(1200), np.full((1200, embedding_dedup.DEGREE), -1))]
    a, b = embedding_dedup.links_of(vectors, layers, queries, np.arange(1200), 0.93)
    true = set(zip(*(x.tolist() for x in np.nonzero(queries @ vectors.T >= 0.93)), strict=True))
    found = set(zip(a.tolist(), b.tolist(), strict=True))
    assert len(true) >= 3 and found <= true and len(found) >= 0.98 * len(true)


def test_language_is_the_same_whatever_is_sent_out(spark):
    """Rare words and n-grams count as known ones: the share that decides what is sent out changes no score."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    few, all_ = (language_id.predict_languages(docs, language_id.learn_languages(docs, share)).collect() for share in (2e-3, 5e-6))
    found = {r.doc_id: r for r in few}
    assert len(found) == len(all_) and sum(r.lang_pred != "und" for r in all_) > 100
    for r in all_:
        assert found[r.doc_id].lang_pred == r.lang_pred and math.isclose(found[r.doc_id].score, r.score, rel_tol=1e-6, abs_tol=1e-12)
