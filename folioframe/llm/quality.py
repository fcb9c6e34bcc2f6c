"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its words (lower-case A-Z, hashed into `BUCKETS`, values of unit length), statistics of its
structure and the logarithm of its recorded length. The machine adds a weight for each feature and, for each pair of
features, the product of their factors; the pairs are summed in linear time as half of (sum of v x) squared less the
sum of (v x) squared, for each factor.

It is fitted on at most `max_rows` labelled documents, those with the least hash of the id, by AdaGrad on the logistic
loss. Language, source, id and labels are no inputs of a score. A null text counts as empty, a null length as that of
the text. Without labels of both kinds every score is the share of label 1 (0.5 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import coded, flat_words, hashed, parts, remainder, widened

BUCKETS = 1 << 16
FACTORS = 8
THRESHOLD = 0.3
FEATURES = (
    "log_words", "log_length", "symbols", "capitals", "digits", "other_scripts", "punctuation", "distinct_words",
    "repeated_neighbours", "word_length", "commonest_word", "bars", "exclamations", "lines", "distinct_lines", "commonest_byte",
)

_CLASSES = {
    "symbols": b"#$%&*!|@^~<>=+_/\\{}[]`",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digits": b"0123456789",
    "other": bytes(range(128, 256)),
    "punctuation": b".,;:'\"?-()",
    "bars": b"|",
    "exclamations": b"!",
    "lines": b"\n",
}


def structure(texts: pa.Array, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Statistics of each text (rows x FEATURES), and its hashed words: row, bucket, value."""
    n = len(texts)
    plain = texts.cast(pa.large_string())
    offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + n + 1]
    data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets - offsets[0]
    size = np.maximum(np.diff(ends), 1).astype(float)
    share = {}
    for name, members in _CLASSES.items():
        chosen = np.zeros(256, bool)
        chosen[list(members)] = True
        share[name] = np.diff(np.searchsorted(np.flatnonzero(chosen[data]), ends)) / size
    words, rows = flat_words(texts)
    codes, known = coded(words)
    counts = np.bincount(rows, minlength=n).astype(float)
    at_least = np.maximum(counts, 1)
    pairs, times = np.unique(rows * (len(known) + 1) + codes, return_counts=True)
    row, code = pairs // (len(known) + 1), pairs % (len(known) + 1)
    distinct = np.bincount(row, minlength=n)
    commonest = np.zeros(n)
    np.maximum.at(commonest, row, times)
    same = (rows[1:] == rows[:-1]) & (codes[1:] == codes[:-1]) if len(rows) else np.zeros(0, bool)
    neighbours = np.bincount(rows[1:][same], minlength=n) if len(rows) else np.zeros(n)
    letters = np.bincount(rows, weights=pc.binary_length(words).to_numpy(zero_copy_only=False), minlength=n) if len(rows) else np.zeros(n)
    lines = pc.split_pattern(texts, "\n")
    line_row = np.repeat(np.arange(n), np.diff(lines.offsets.to_numpy()))
    line_code = lines.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line_pairs = np.unique(line_row * (len(line_code) + 1) + line_code)
    n_lines = np.maximum(np.bincount(line_row, minlength=n), 1)
    capitals = share["upper"] / np.maximum(share["upper"] + share["lower"], 1e-9)
    dense = np.column_stack([
        np.log1p(counts), np.log1p(np.maximum(length, 0)), share["symbols"], capitals, share["digits"], share["other"], share["punctuation"],
        distinct / at_least, neighbours / at_least, np.log1p(letters / at_least), commonest / at_least, share["bars"], share["exclamations"],
        share["lines"] * size / at_least, np.bincount(line_pairs // (len(line_code) + 1), minlength=n) / n_lines, np.maximum(share["symbols"], share["upper"]),
    ])
    buckets = (hashed(known) % np.uint64(BUCKETS)).astype(np.int64)[code] if len(pairs) else np.zeros(0, np.int64)
    keys, where = np.unique(row * BUCKETS + buckets, return_inverse=True)
    value = np.log1p(np.bincount(where, weights=times, minlength=len(keys)))
    row = keys // BUCKETS
    norm = np.sqrt(np.bincount(row, weights=value**2, minlength=n))
    return dense, row, keys % BUCKETS, value / norm[row]


@dataclass
class Machine:
    """Weights: bias, one weight and FACTORS factors for each feature, words behind the statistics."""

    bias: float
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def standard(self, dense: np.ndarray) -> np.ndarray:
        return np.clip((dense - self.mean) / self.scale, -4, 4)

    def margin(self, x: np.ndarray, row: np.ndarray, bucket: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score before the logistic function, and the factor sums."""
        n, d = x.shape
        at = bucket + d
        out = self.bias + x @ self.weight[:d] + np.bincount(row, weights=self.weight[at] * value, minlength=n)
        sums = x @ self.factor[:d]
        squares = x**2 @ self.factor[:d] ** 2
        for f in range(self.factor.shape[1]):
            part = self.factor[at, f] * value
            sums[:, f] += np.bincount(row, weights=part, minlength=n)
            squares[:, f] += np.bincount(row, weights=part**2, minlength=n)
        return out + 0.5 * (sums**2 - squares).sum(axis=1), sums

    def score(self, dense: np.ndarray, row: np.ndarray, bucket: np.ndarray, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.standard(dense), row, bucket, value)[0], -60, 60)))


def fit(dense: np.ndarray, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, label: np.ndarray, rounds: int = 20, batch: int = 128) -> Machine:
    """AdaGrad over shuffled batches; `row` ascends."""
    n, d = dense.shape
    rng = np.random.default_rng(17)
    scale = dense.std(axis=0) if n else np.ones(d)
    share = (label.sum() + 0.5) / (n + 1)
    model = Machine(float(np.log(share / (1 - share))), dense.mean(axis=0) if n else np.zeros(d), np.where(scale > 1e-9, scale, 1.0), np.zeros(d + BUCKETS), rng.normal(0, 0.02, (d + BUCKETS, FACTORS)))
    if n == 0 or label.min() == label.max():
        model.factor[:] = 0
        return model
    starts = np.searchsorted(row, np.arange(n + 1))
    x_all = model.standard(dense)
    seen_w, seen_v, seen_b = np.full(d + BUCKETS, 1e-2), np.full((d + BUCKETS, FACTORS), 1e-2), 1e-2
    rate, decay = 0.1, 1e-3
    for _ in range(rounds):
        order = rng.permutation(n)
        for k in range(0, n, batch):
            rows = order[k : k + batch]
            spans = [np.arange(starts[r], starts[r + 1]) for r in rows]
            own = np.repeat(np.arange(len(rows)), [len(s) for s in spans])
            at = np.concatenate(spans)
            x, b, v = x_all[rows], bucket[at], value[at]
            margin, sums = model.margin(x, own, b, v)
            error = (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - label[rows]) / len(rows)
            touched, where = np.unique(b, return_inverse=True)
            places = np.concatenate([np.arange(d), touched + d])
            grad_w = np.concatenate([error @ x, np.bincount(where, weights=error[own] * v, minlength=len(touched))])
            grad_v = np.empty((len(places), FACTORS))
            for f in range(FACTORS):
                grad_v[:d, f] = (error * sums[:, f]) @ x - (error @ x**2) * model.factor[:d, f]
                grad_v[d:, f] = np.bincount(where, weights=error[own] * v * (sums[own, f] - model.factor[b + d, f] * v), minlength=len(touched))
            grad_w += decay * model.weight[places]
            grad_v += decay * model.factor[places]
            seen_w[places] += grad_w**2
            seen_v[places] += grad_v**2
            seen_b += error.sum() ** 2
            model.weight[places] -= rate * grad_w / np.sqrt(seen_w[places])
            model.factor[places] -= 0.5 * rate * grad_v / np.sqrt(seen_v[places])
            model.bias -= rate * error.sum() / np.sqrt(seen_b)
    return model


def _inputs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    texts = batch.column("text").cast(pa.string()).fill_null("")
    length = pc.utf8_length(texts).cast(pa.int64())
    if "n_chars" in batch.schema.names:
        length = pc.coalesce(batch.column("n_chars").cast(pa.int64()), length)
    return structure(texts, length.to_numpy(zero_copy_only=False).astype(float))


def _input_columns(docs: DataFrame, *more: str) -> list[str]:
    return [*more, "text", *(["n_chars"] if "n_chars" in docs.columns else [])]


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 6000) -> Machine:
    """Fits on at most `max_rows` labelled documents; rows with crc32(doc_id) mod 5 = 0 are held out."""
    known = labels.filter(F.col("quality").isin(0, 1) & (remainder("doc_id", 5) > 0)).select("doc_id", F.col("quality").cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    rows = docs.select(_input_columns(docs, "doc_id")).join(chosen, "doc_id")
    schema = "doc_id string, label int, dense array<double>, bucket array<int>, value array<double>"

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            dense, row, bucket, value = _inputs(batch)
            n = batch.num_rows
            ends = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
            lists = [
                pa.FixedSizeListArray.from_arrays(pa.array(dense.ravel()), dense.shape[1]).cast(pa.list_(pa.float64())),
                pa.ListArray.from_arrays(ends, pa.array(bucket, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(value)),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("label"), *lists], ["doc_id", "label", "dense", "bucket", "value"])

    found = rows.mapInArrow(features, schema).toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")]).combine_chunks()
    if not found.num_rows:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    dense = np.array(found.column("dense").to_pylist())
    sizes = pc.list_value_length(found.column("bucket")).to_numpy()
    flat = [pc.list_flatten(found.column(c)).to_numpy() for c in ("bucket", "value")]
    return fit(dense, np.repeat(np.arange(len(dense)), sizes), flat[0].astype(np.int64), flat[1], found.column("label").to_numpy().astype(float))


def score_quality(docs: DataFrame, model: Machine, into: str = "score") -> DataFrame:
    """Adds the probability of label 1 to the rows of `docs` (doc_id, text, perhaps n_chars and more)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(into)
    schema = widened(kept, into, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(*_inputs(batch)))], names=[f.name for f in schema])

    return kept.mapInArrow(run, schema)


def predict_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 6000) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if score >= 0.3) of every row of `docs`."""
    model = fit_quality(docs, labels, max_rows)
    scored = score_quality(docs.select(_input_columns(docs, "doc_id")), model)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
