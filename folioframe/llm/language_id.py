"""Language identification by words first, then by ever shorter character n-grams.

Training counts the words (runs of letters, lower case) of every language, and the n-grams of up to `LONGEST`
characters of all of them, with a space at both ends. All counts stay in two tables, with the log shares of each word
or n-gram in every language. Those that make up at least `min_share` of some language's words (of its n-grams of that
length) are sent out: at most 1 / min_share for each language and length, whatever the corpus. Texts meet all others
in a join, so `min_share` never changes what is known.

A text's score for a language is the sum over its words: the log share of a known word, a floor where only other
languages know it, which is a tenth of an occurrence in the largest language (or in 200,000 words, if that has fewer).
A word that no language knows is scored by the mean over its longest n-grams of which one is known, or the next
shorter ones. The language with the greatest sum wins, at ties the first in order. `score` is its share among the
languages when sums are made probabilities.

A text that is null or has no letter, and any text when nothing was learned, gives `und` and score 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import coded, hashed, parts, remainder, staged

LONGEST = 4
#: Greatest floor of a share.
FLOOR = 5e-7
LETTERS = r"[^\p{L}]+"
#: Longest part of a word that n-grams are taken from in one array; longer words are cut into such parts.
PART = 24


def letter_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of letters in lower case, and the row of each."""
    plain = pc.utf8_lower(pc.replace_substring_regex(texts.fill_null(""), LETTERS, " "))
    lists = pc.ascii_split_whitespace(plain)
    rows = np.repeat(np.arange(len(lists), dtype=np.int64), np.diff(lists.offsets.to_numpy()))
    words = lists.flatten()
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    return words.filter(pa.array(full)), rows[full]


def word_parts(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of " word " as a matrix, its length, and the word's place; a long word takes several rows."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    points = np.frombuffer("".join(f" {w} " for w in words.to_pylist()).encode("utf-32-le"), np.uint32)
    starts = np.cumsum(lengths) - lengths
    step = PART - LONGEST + 1
    pieces = np.maximum(1, -(-(lengths - LONGEST + 1) // step))
    word = np.repeat(np.arange(len(lengths)), pieces)
    offset = (np.arange(len(word)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * step
    size = np.minimum(PART, lengths[word] - offset)
    points = np.concatenate([points, np.zeros(PART, np.uint32)])
    return points[(starts[word] + offset)[:, None] + np.arange(PART)], size, word


def gram_codes(matrix: np.ndarray, size: np.ndarray, n: int, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams as strings of n characters with the row of each. `first` marks rows that begin a word: later parts
    repeat the last n - 1 characters of the one before, so shorter n-grams there are left out."""
    cells = np.arange(PART - n + 1)
    inside = cells[None, :] + n <= size[:, None]
    repeated = ~first[:, None] & (cells[None, :] + n <= LONGEST - 1)
    rows, at = np.nonzero(inside & ~repeated)
    grams = np.ascontiguousarray(np.stack([matrix[rows, at + k] for k in range(n)], axis=1))
    return rows, grams.view(f"<U{n}")[:, 0]


@dataclass
class LanguageModel:
    languages: list[str]
    words: tuple[np.ndarray, np.ndarray]  # of frequent words: sorted hashes, log shares (entries x languages)
    grams: dict[int, tuple[np.ndarray, np.ndarray]]  # of frequent n-grams, by length
    word_table: DataFrame | None = None  # word, scores: all words
    gram_table: DataFrame | None = None  # gram, size, scores: all n-grams
    floors: dict[int, float] | None = None  # log share of an n-gram that a language does not know, by length


def _places(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key among the sorted ones, and whether it is there."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return place, known[place] == keys


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        words, rows = letter_words(batch.column("text"))
        codes, known = coded(words)
        width = max(len(langs.dictionary), 1)
        keys, counts = np.unique(codes * width + langs.indices.to_numpy(zero_copy_only=False)[rows], return_counts=True)
        columns = [langs.dictionary.take(pa.array(keys % width)), known.take(pa.array(keys // width)), pa.array(counts)]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        lang_of = langs.indices.to_numpy(zero_copy_only=False)
        times = batch.column("n").to_numpy()
        for k in range(0, batch.num_rows, 65536):
            matrix, size, word = word_parts(batch.column("word").slice(k, 65536))
            if not len(word):
                continue
            first = np.concatenate([[True], word[1:] != word[:-1]])
            for n in range(1, LONGEST + 1):
                rows, grams = gram_codes(matrix, size, n, first)
                where = word[rows] + k
                for code, name in enumerate(langs.dictionary.to_pylist()):
                    own = lang_of[where] == code
                    found, back = np.unique(grams[own], return_inverse=True)
                    total = np.bincount(back, weights=times[where[own]], minlength=len(found)).astype(np.int64)
                    columns = [pa.array([name] * len(found), pa.string()), pa.array(found.tolist(), pa.string()), pa.array([n] * len(found), pa.int32()), pa.array(total)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "size", "n"])


def _scored(counts: DataFrame, keys: list[str], group: list[str], languages: list[str], min_share: float, label: str) -> tuple[DataFrame, dict]:
    """Log shares of every entry in all languages, whether it is frequent in one, and the floors by group (of one key)."""
    totals = {(r["lang"], *(r[g] for g in group)): r["total"] for r in counts.groupBy("lang", *group).agg(F.sum("n").alias("total")).collect()}
    groups = sorted({k[1:] for k in totals})
    floors = {g: float(np.log(min(FLOOR, 0.1 / max(n for k, n in totals.items() if k[1:] == g)))) for g in groups}

    def of_group(value) -> Column:
        if not group:
            return F.lit(value(()))
        return F.coalesce(*(F.when(F.col(group[0]) == g[0], F.lit(value(g))) for g in groups))

    seen = [F.sum(F.when(F.col("lang") == x, F.col("n"))).alias(f"n_{j}") for j, x in enumerate(languages)]
    wide = counts.groupBy(*keys).agg(*seen)
    shares = [F.col(f"n_{j}") / of_group(lambda g, x=x: float(totals.get((x, *g), 1))) for j, x in enumerate(languages)]
    scores = F.array(*(F.coalesce(F.log(c), of_group(lambda g: floors[g])) for c in shares)).alias("scores")
    often = F.exists(F.array(*shares), lambda c: F.coalesce(c, F.lit(0.0)) >= min_share).alias("often")
    return staged(wide.select(*keys, scores, often), label), floors


def _table(found: pa.Table, name: str, width: int, key) -> tuple[np.ndarray, np.ndarray]:
    if not found.num_rows:
        return np.zeros(0, np.uint64), np.zeros((0, width))
    keys = key(found.column(name).combine_chunks())
    order = np.argsort(keys, kind="stable")
    return keys[order], pc.list_flatten(found.column("scores")).to_numpy().reshape(-1, width)[order]


def learn_languages(docs: DataFrame, min_share: float = 5e-6) -> LanguageModel:
    """Learns from rows whose language is not null and whose crc32(doc_id) mod 4 is not 2."""
    rows = docs.filter(F.col("lang").isNotNull() & (remainder("doc_id", 4) != 2)).select("lang", F.col("text").cast("string").alias("text"))
    words = rows.mapInArrow(_word_counts, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = staged(words, "language-words")
    languages = sorted(r.lang for r in words.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], (np.zeros(0, np.uint64), np.zeros((0, 0))), {})
    grams = words.mapInArrow(_gram_counts, "lang string, gram string, size int, n bigint").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    word_table, _ = _scored(words, ["word"], [], languages, min_share, "language-word-scores")
    gram_table, floors = _scored(staged(grams, "language-grams"), ["gram", "size"], ["size"], languages, min_share, "language-gram-scores")
    known, parts_ = word_table.filter("often").toArrow(), gram_table.filter("often").toArrow()
    width = len(languages)
    by_size = {}
    for n in range(1, LONGEST + 1):
        some = parts_.filter(pc.equal(parts_.column("size"), n))
        if some.num_rows:
            by_size[n] = _table(some, "gram", width, lambda x, n=n: np.array(x.to_pylist(), f"<U{n}"))
    return LanguageModel(languages, _table(known, "word", width, hashed), by_size, word_table.drop("often"), gram_table.drop("often"), {g[0]: x for g, x in floors.items()})


def _lists(values: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))


def backed_off(words: DataFrame, model: LanguageModel, shared) -> DataFrame:
    """word and scores of distinct words that no language knows, by their n-grams; words without known ones give zeros."""
    width, schema = len(model.languages), "word string, size int, gram string, times bigint, hits bigint, sums array<double>"
    names = [f.split()[0] for f in schema.split(", ")]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each length down to one with a frequent n-gram: what the frequent ones give, and all others as rows."""
        _, known_grams = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, 16384):
                left = batch.column("word").slice(k, 16384)
                for n in range(LONGEST, 0, -1):
                    if not len(left):
                        break
                    known, scores = known_grams.get(n, (np.zeros(0, f"<U{n}"), np.zeros((0, width))))
                    matrix, size, word = word_parts(left)
                    first = np.concatenate([[True], word[1:] != word[:-1]])
                    rows, grams = gram_codes(matrix, size, n, first)
                    place, hit = _places(known, grams)
                    owner, m = word[rows], len(left)
                    hits = np.bincount(owner[hit], minlength=m)
                    sums = np.column_stack([np.bincount(owner[hit], weights=scores[place[hit], j], minlength=m) for j in range(width)])
                    nulls = pa.nulls(m, pa.string())
                    yield pa.RecordBatch.from_arrays([left, pa.array([n] * m, pa.int32()), nulls, pa.array(np.bincount(owner, minlength=m)), pa.array(hits), _lists(sums)], names)
                    some, where = grams[~hit], owner[~hit]
                    kinds, codes = np.unique(some, return_inverse=True)
                    pairs, times = np.unique(where * max(len(kinds), 1) + codes, return_counts=True)
                    asked = pa.array(kinds.tolist(), pa.string()).take(pa.array(pairs % max(len(kinds), 1)))
                    r = len(pairs)
                    columns = [left.take(pa.array(pairs // max(len(kinds), 1))), pa.array([n] * r, pa.int32()), asked, pa.array(times), pa.nulls(r, pa.int64()), pa.nulls(r, pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(columns, names)
                    left = left.filter(pa.array(hits == 0))

    tallied = staged(words.mapInArrow(tally, schema), "language-gram-tallies")
    rare = tallied.filter(F.col("gram").isNotNull()).select("word", "size", "gram", "times").join(model.gram_table, ["gram", "size"])
    rare = rare.select("word", "size", F.lit(0).cast("long").alias("total"), F.col("times").alias("hits"), *((F.col("scores")[j] * F.col("times")).alias(f"s_{j}") for j in range(width)))
    sent = tallied.filter(F.col("gram").isNull()).select("word", "size", F.col("times").alias("total"), "hits", *(F.col("sums")[j].alias(f"s_{j}") for j in range(width)))
    both = sent.union(rare).groupBy("word", "size").agg(*(F.sum(c).alias(c) for c in ("total", "hits", *(f"s_{j}" for j in range(width)))))
    floor = F.coalesce(*(F.when(F.col("size") == n, F.lit(x)) for n, x in model.floors.items()))
    mean = F.array(*((F.col(f"s_{j}") + (F.col("total") - F.col("hits")) * floor) / F.col("total") for j in range(width)))
    longest = both.groupBy("word").agg(F.max(F.when(F.col("hits") > 0, F.struct("size", mean.alias("scores")))).alias("longest"))
    return longest.select("word", F.coalesce("longest.scores", F.array(*[F.lit(0.0)] * width)).alias("scores"))


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `docs`; only the text is an input."""
    held, languages, width = (remainder("doc_id", 4) == 2).alias("held_out"), model.languages, len(model.languages)
    if not languages:
        return docs.select("doc_id", held, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.grams))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {kind}, word string, times bigint, some boolean, sums array<double>"
    names = [f.split()[0] for f in schema.split(", ")]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, scores), _ = shared.value
        for batch in parts(batches):
            n = batch.num_rows
            words, owner = letter_words(batch.column("text"))
            codes, distinct = coded(words)
            place, sent = _places(known, hashed(distinct))
            here = sent[codes]
            sums = np.column_stack([np.bincount(owner[here], weights=scores[place[codes[here]], j], minlength=n) for j in range(width)])
            ids, some = batch.column("doc_id"), np.bincount(owner, minlength=n) > 0
            yield pa.RecordBatch.from_arrays([batch.column("row"), ids, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array(some), _lists(sums)], names)
            pairs, times = np.unique(owner[~here] * max(len(distinct), 1) + codes[~here], return_counts=True)
            r, at = len(pairs), pa.array(pairs // max(len(distinct), 1))
            columns = [batch.column("row").take(at), pa.nulls(r, ids.type), distinct.take(pa.array(pairs % max(len(distinct), 1))).cast(pa.string()), pa.array(times)]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(r, pa.bool_()), pa.nulls(r, pa.list_(pa.float64()))], names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    tallied = staged(rows.mapInArrow(tally, schema), "language-tallies")
    rest = tallied.filter(F.col("word").isNotNull()).select("row", "word", "times")
    asked = rest.select("word").distinct()
    known = asked.join(model.word_table, "word").select("word", "scores")
    values = staged(known.union(backed_off(asked.join(model.word_table, "word", "left_anti"), model, shared)), "language-values")
    met = rest.join(values, "word").groupBy("row").agg(*(F.sum(F.col("scores")[j] * F.col("times")).alias(f"r_{j}") for j in range(width)))
    texts = tallied.filter(F.col("word").isNull()).select("row", "doc_id", "some", "sums").join(met, "row", "left")
    whole = F.array(*(F.col("sums")[j] + F.coalesce(f"r_{j}", F.lit(0.0)) for j in range(width))).alias("sums")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pc.list_flatten(batch.column("sums")).to_numpy(zero_copy_only=False).reshape(-1, width)
            some = batch.column("some").to_numpy(zero_copy_only=False)
            score = np.where(some, 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1), 0.0)
            best = [languages[b] if s else "und" for b, s in zip(sums.argmax(axis=1).tolist(), some.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    found = texts.select("doc_id", "some", whole).mapInArrow(choose, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held, "lang_pred", "score")
