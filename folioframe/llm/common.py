"""Pieces that several operators share: staged tables, blocks of documents, words and shingles as arrays."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, shuffles_dropped
from ..sinks.commits import delete

#: ASCII white space, the only characters that end a word: x20 and x09 to x0D.
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` to the shared folder and reads it back: lineage is cut and lost executors cost nothing twice. The step's
    shuffle files go when it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes staged tables that nothing will read any more."""
    for df in frames:
        delete(df.sparkSession, df.staged_at)


def widened(df: DataFrame, name: str, kind: str) -> T.StructType:
    """Schema of `df` with one more column."""
    return T.StructType([*df.schema.fields, T.StructField(name, T._parse_datatype_string(kind))])


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def remainder(column: str, divisor: int) -> Column:
    """crc32 of an id's text modulo `divisor`; a null id has remainder -1, so it belongs to no held-out share."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(divisor), F.lit(-1))


def text_column(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def block_count(docs: DataFrame, column: str, target_bytes: int) -> int:
    """How many blocks hold about `target_bytes` of text each; at least one for each shuffle partition."""
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-int(total) // target_bytes))


def release() -> None:
    """Gives memory that is no longer used back to the machine: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def parts(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about `most` bytes of text, so that memory follows that and not the batch."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
        release()


def word_lists(texts: pa.Array) -> pa.ListArray:
    """Words of each text in lower-case A-Z, split at ASCII white space; empty words are left out by `flat_words`."""
    return pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))


def flat_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch in one array, and for each word the row of its text (ascending)."""
    lists = word_lists(texts)
    rows = np.repeat(np.arange(len(lists), dtype=np.int64), np.diff(lists.offsets.to_numpy()))
    words = lists.flatten()
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        words, rows = words.filter(pa.array(full)), rows[full]
    return words, rows


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words and the distinct words."""
    found = words.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + _MIX[0]
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hash of each string: its bytes, eight at a time, through the finaliser, with the length."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    out = mixed(sizes.astype(np.uint64))
    if not len(words):
        return out
    plain = words.cast(pa.large_binary())
    offsets = np.frombuffer(plain.buffers()[1], dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(plain.buffers()[2] or b"", dtype=np.uint8)
    data = np.concatenate([data[: offsets[-1]], np.zeros(8, np.uint8)])
    alive, at = np.arange(len(words)), 0
    lane = np.arange(8)
    while True:
        alive = alive[sizes[alive] > at]
        if not len(alive):
            return out
        chunk = data[(offsets[alive] + at)[:, None] + lane]
        left = (sizes[alive] - at)[:, None]
        chunk = np.where(lane < left, chunk, 0).astype(np.uint8)
        out[alive] = mixed(out[alive] ^ mixed(np.ascontiguousarray(chunk).view(np.uint64)[:, 0]))
        at += 8


def word_shingles(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all texts of a batch: row of the text, 64-bit hash, first word's place in the batch.

    A text with fewer words than `width` has its whole sequence as one shingle; a text without words has none.
    """
    words, rows = flat_words(texts)
    codes, known = coded(words)
    values = hashed(known)[codes] if len(codes) else np.zeros(0, np.uint64)
    n = len(values)
    places = np.arange(n, dtype=np.int64)
    counts = np.bincount(rows, minlength=len(texts)) if n else np.zeros(len(texts), np.int64)
    starts = np.cumsum(counts) - counts
    width_of = np.minimum(counts, width)[rows] if n else places
    begins = places + width_of <= (starts + counts)[rows] if n else np.zeros(0, bool)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            inside = k < width_of
            moved = np.zeros(n, np.uint64)
            moved[: max(n - k, 0)] = values[k:]
            out = np.where(inside, mixed(out ^ moved), out)
    short = width_of < width
    out = np.where(short, mixed(out ^ width_of.astype(np.uint64)), out)
    return rows[begins], out[begins], places[begins]


def distinct_per_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, sorted by row and value."""
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[fresh], values[fresh]


def crc(text: str) -> int:
    return zlib.crc32(text.encode())
