"""Benchmark decontamination: MinHash containment search of short test items in long documents.

Words are lower-case A-Z runs of non-space characters, shingles are `WIDTH` of them. Items are parted by the size of
their shingle sets (powers of two); within a part with sizes up to u an item's sketch is its u - ceil(t u) + 1 least
shingle hashes (MinHash, all of them if it has fewer). A document that holds the share t of an item lacks at most
u - ceil(t u) of its shingles, so it holds one of the sketch: the search loses nothing, however long the document.

Documents are searched by their own shingle hashes against a bitmap of the sketches, whose size is fixed; what passes
is joined with the sketches by the shingle itself. Candidates are verified by exact containment: the shingles of the
item that the document holds, divided by all of the item's.

Items with fewer than `WIDTH` words have no shingle and match nothing, and so do null or empty texts. Documents without
an id are not searched; rows with one id count as one document. Repeated item rows count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_words, parts, staged, word_shingles

WIDTH = 5
BITS = 24  # the bitmap has 2 ** BITS bits, 2 MB


def _shingle_rows(rows: np.ndarray, hashes: np.ndarray, places: np.ndarray, ids: pa.Array, words: pa.Array, names: list[str]) -> pa.RecordBatch:
    text = words.take(pa.array((places[:, None] + np.arange(WIDTH)).ravel())).to_pylist()
    joined = [" ".join(text[k : k + WIDTH]) for k in range(0, len(text), WIDTH)]
    return pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(joined, pa.string()), pa.array(hashes.view(np.int64))], names)


def shingle_rows(df: DataFrame, key: str, bitmap: np.ndarray | None = None) -> DataFrame:
    """Rows (key, shingle, hash) of the shingles of `df` (key, text), only those whose bit is set if a bitmap is given."""
    shared = None if bitmap is None else df.sparkSession.sparkContext.broadcast(bitmap)
    schema = T.StructType([df.schema[key], T.StructField("shingle", T.StringType()), T.StructField("hash", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            words, word_rows = flat_words(batch.column("text"))
            rows, hashes, places = word_shingles(batch.column("text"), WIDTH)
            whole = np.bincount(word_rows, minlength=batch.num_rows)[rows] >= WIDTH if len(rows) else np.zeros(0, bool)
            if shared is not None:
                cell = hashes >> np.uint64(64 - BITS)
                whole &= (shared.value[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1
            yield _shingle_rows(rows[whole], hashes[whole], places[whole], batch.column(key), words, [key, "shingle", "hash"])

    plain = df.filter(F.col(key).isNotNull()).select(key, F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, schema)


def bitmap_of(shingles: DataFrame) -> np.ndarray:
    """Bit for each hash; the words of 64 bits are or-ed by Spark, at most 2 ** (BITS - 6) of them reach the driver."""
    cell = F.shiftrightunsigned("hash", 64 - BITS)
    bits = shingles.select(F.shiftrightunsigned(cell, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - BITS}) & 63 as int))").alias("bit"))
    found = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_common and containment of every pair with containment >= threshold."""
    share = F.lit(round(threshold * 1000))
    shingles = shingle_rows(items, "item_id").dropDuplicates(["item_id", "shingle"])
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("n_item_shingles"))
    upper = F.pow(2, F.ceil(F.log2("n_item_shingles"))).cast("long")
    sketch_size = upper - F.ceil(share * upper / 1000) + 1
    known = staged(shingles.join(sizes.withColumn("sketch_size", sketch_size), "item_id"), "item-shingles")
    by_hash = F.row_number().over(Window.partitionBy("item_id").orderBy("hash", "shingle"))
    sketches = staged(known.withColumn("place", by_hash).filter("place <= sketch_size").select("shingle", "hash", "item_id"), "item-sketches")
    hits = shingle_rows(docs, "doc_id", bitmap_of(sketches)).select("doc_id", "shingle")
    candidates = staged(hits.join(sketches.select("shingle", "item_id"), "shingle").select("doc_id", "item_id").distinct(), "leak-candidates")
    chosen = docs.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    held = shingle_rows(chosen, "doc_id", bitmap_of(known)).select("doc_id", "shingle").distinct()
    pairs = held.join(known.select("shingle", "item_id", "n_item_shingles"), "shingle").join(candidates, ["doc_id", "item_id"], "left_semi")
    counted = pairs.groupBy("doc_id", "item_id", "n_item_shingles").agg(F.count("*").alias("n_common"))
    return counted.filter(F.col("n_common") * 1000 >= share * F.col("n_item_shingles")).withColumn("containment", F.col("n_common") / F.col("n_item_shingles"))


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """`docs` less those that hold an item."""
    return docs.join(find_leaks(docs, items, threshold).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


WORDS_SQL = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
SQL = f"""
WITH item_words AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
item AS (SELECT DISTINCT item_id, unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) AS s FROM item_words WHERE len(w) >= 5),
size AS (SELECT item_id, count(*) AS n_item_shingles FROM item GROUP BY item_id),
doc_words AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents WHERE doc_id IS NOT NULL),
doc AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) AS s FROM doc_words WHERE len(w) >= 5),
pair AS (SELECT doc_id, item_id, count(*) AS n_common FROM doc JOIN item USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item_shingles, n_common, n_common / n_item_shingles AS containment
FROM pair JOIN size USING (item_id) WHERE n_common * 1000 >= 800 * n_item_shingles
"""
