"""Jaccard join on word shingles by a size-aware heavy-light join, with the components of its links.

A document's set is its distinct shingles of `WIDTH` words (lower-case A-Z runs of non-space characters; with fewer
words the whole sequence, without words nothing). Two documents link when 100 |A and B| >= 80 |A or B|.

Equal sets are one node from the start, so copies are never paired. Nodes with at most `boundary` shingles are light:
two of them that link share a subset of the size that their link needs, and every such subset is enumerated as a key.
All pairs with a heavy node are found in inverted lists over the shingles of a prefix, rare ones first: of n shingles,
n - ceil(0.8 n) + 1 must hold one that the partner's prefix holds too. The boundary is that with the least cost: keys
enumerated below it, list entries scanned above it, both from the measured sizes and list lengths. Shingles seen often
(counted over all texts, batch by batch) come last in the order of prefixes; any order gives the same links, so it may
rest on a bounded table of the `HOT` most frequent ones.

The members of a list are compared in rounds. In each, they meet some pivots of their list, `GROWTH` times as many as in
the round before, as far as they are not yet in one component with them; only pairs whose parity bits leave a link open
become rows, and the links found join components. So a group of near copies makes about as many pairs as it needs to be
joined, however many of its pairs link, and once all members of a list have been pivots no link between components is lost.
Parity bits (the parity of the shingles that fall on each of 1024 places, or of more places for larger sets) never count
more differences than there are; pairs that pass are settled by the exact sets, made anew where the texts lie: a bitmap of
fixed size tells there which texts are wanted (and some that are not), so no text is shuffled.

Nodes are 64-bit hashes of the sorted set. Rows without an id have no component and link with nothing; rows of empty
sets are alone. Repeated rows are one node. Columns beside doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import ceil, comb
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, distinct_per_row, mixed, parts, staged, word_shingles
from .components import components
from .decontamination import WORDS_SQL

WIDTH = 5
HOT = 1 << 17
LIGHT = 12  # greatest boundary that is considered
WORDS64 = 16  # words of the short parity of a set, and least words of the wide one
GROWTH = 16  # pivots of a list in a round, as a multiple of those in the round before
FEW = 32  # comparisons for each entry of the open lists, up to which all are made in one round
MARKS = 1 << 19  # words of the bitmap of wanted texts
_SET = "doc_id {id}, node bigint, n bigint, short array<bigint>, wide array<bigint>, prefix array<bigint>, light array<bigint>"


def sets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and sorted hashes of the sets, their sizes and nodes."""
    rows, hashes, _ = word_shingles(texts, WIDTH)
    rows, hashes = distinct_per_row(rows, hashes)
    n = np.bincount(rows, minlength=len(texts)).astype(np.int64)
    at = np.arange(len(rows)) - (np.cumsum(n) - n)[rows]
    with np.errstate(over="ignore"):
        terms = mixed(hashes + mixed(at.astype(np.uint64)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        ends = np.concatenate([[0], np.cumsum(n)])
        node = mixed(sums[ends[1:]] - sums[ends[:-1]] + n.astype(np.uint64))
    return rows, hashes, n, node.view(np.int64)


def parity(rows: np.ndarray, hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Parity bits of each row in as many 64-bit words, a power of two, one row after another."""
    start = np.cumsum(words) - words
    bit = start[rows] * 64 + (hashes & (64 * words[rows] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(bit, minlength=int(words.sum()) * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that four different sets of a batch hold; one that is frequent anywhere is found in some batch. Copies
    are one node, so what only copies repeat makes no list long and is not counted."""
    for batch in parts(batches, most=12 << 20):
        rows, hashes, _, node = sets_of(batch.column("text"))
        once = np.zeros(len(node), bool)
        once[np.unique(node, return_index=True)[1]] = True
        hashes = np.sort(hashes[once[rows]])
        starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([starts, [len(hashes)]]))
        some = counts >= 4
        yield pa.RecordBatch.from_arrays([pa.array(hashes[starts[some]].view(np.int64)), pa.array(counts[some])], ["hash", "n"])


def hot_shingles(docs: DataFrame) -> np.ndarray:
    """Hashes of at most `HOT` shingles, the most frequent last."""
    counts = docs.select("text").mapInArrow(_often, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))
    found = counts.filter("n >= 8").orderBy(F.desc("n"), "hash").limit(HOT).toArrow()
    return found.column("hash").to_numpy()[::-1].view(np.uint64)


def described(docs: DataFrame) -> DataFrame:
    """Set size, node, parity, prefix (rarest first) and, for small sets, all shingles of every row."""
    hot = hot_shingles(docs)
    order = np.argsort(hot)
    shared = docs.sparkSession.sparkContext.broadcast((hot[order], order + 1))
    schema = _SET.format(id=docs.schema["doc_id"].dataType.simpleString())

    def lists(rows: np.ndarray, values: np.ndarray, n: int) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32()), pa.array(values.view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for batch in parts(batches):
            rows, hashes, n, node = sets_of(batch.column("text"))
            count = batch.num_rows
            short = parity(rows, hashes, np.full(count, WORDS64))
            words = WORDS64 << np.maximum(np.ceil(np.log2(np.maximum(n, 1) / (64 * WORDS64))), 0).astype(np.int64)
            words = np.where(words > WORDS64, words, 0)  # none where the short parity says the same
            large = words[rows] > 0
            wide = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(words)]), pa.int32()), pa.array(parity(rows[large], hashes[large], words)))
            level = np.zeros(len(hashes), np.int64)
            if len(known) and len(hashes):
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                level = np.where(known[place] == hashes, rank[place], 0)
            by = np.lexsort((hashes, level, rows))
            at = np.arange(len(rows)) - (np.cumsum(n) - n)[rows]
            head = at < (n - -(-4 * n // 5) + 1)[rows]
            small = n[rows] <= LIGHT
            columns = [
                batch.column("doc_id"), pa.array(node), pa.array(n),
                pa.FixedSizeListArray.from_arrays(pa.array(short), WORDS64).cast(pa.list_(pa.int64())), wide,
                lists(rows[head], hashes[by][head], count), lists(rows[small], hashes[small], count),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "n", "short", "wide", "prefix", "light"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def needed(n: int, m: int) -> int:
    """Shared shingles that sets of sizes n and m need to link: 9 |A and B| >= 4 (n + m)."""
    return ceil(4 * (n + m) / 9)


def subset_sizes(n: int, boundary: int) -> list[int]:
    partners = range(ceil(4 * n / 5), min(boundary, 5 * n // 4) + 1)
    return sorted({needed(n, m) for m in partners if needed(n, m) <= min(n, m)})


def choose_boundary(small: DataFrame) -> int:
    """The boundary with the least cost, from the nodes with at most `LIGHT` shingles: subset keys of light sets and
    list entries scanned for the others."""
    keys = small.select("n", F.explode("prefix").alias("key"))
    length = keys.groupBy("key").agg(F.count("*").alias("length"))
    scans = keys.join(length, "key").groupBy("n").agg(F.sum("length").alias("scan"))
    sizes = small.groupBy("n").agg(F.count("*").alias("sets"))
    measured = {r["n"]: (r["sets"], r["scan"]) for r in sizes.join(scans, "n").collect()}

    def cost(boundary: int) -> float:
        light = sum(s * sum(comb(n, o) for o in subset_sizes(n, boundary)) for n, (s, _) in measured.items() if n <= boundary)
        return light + sum(scan for n, (_, scan) in measured.items() if n >= 4 * (boundary + 1) / 5)

    return min(range(LIGHT + 1), key=lambda b: (cost(b), b))


def subset_keys(nodes: DataFrame, boundary: int) -> DataFrame:
    """A key for each subset of a light set that a link with another light set can need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners = [], []
            for k, values in enumerate(batch.column("light").to_pylist()):
                terms = mixed(np.array(values, np.int64).view(np.uint64))
                for size in subset_sizes(len(values), boundary):
                    chosen = np.array(list(combinations(range(len(values)), size)), np.int64)
                    with np.errstate(over="ignore"):
                        keys.append(mixed(terms[chosen].sum(axis=1, dtype=np.uint64) + np.uint64(size)))
                    owners.append(np.full(len(chosen), k))
            if keys:
                rows = pa.array(np.concatenate(owners))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), batch.column("node").take(rows), batch.column("n").take(rows)], ["key", "node", "n"])

    return nodes.filter(F.col("n") <= boundary).select("node", "n", "light").mapInArrow(run, "key bigint, node bigint, n bigint")


def _close(a: Column, b: Column) -> Column:
    """Whether two set sizes can link at all."""
    return (5 * F.least(a, b)) >= (4 * F.greatest(a, b))


def inverted_lists(nodes: DataFrame) -> DataFrame:
    """Entries (key, node, n, place, core, members, turn, pivot) of all lists with two members at least. `place` is that of
    the key among a set's shingles, `core` marks keys within the shorter prefix that suffices for the smaller set of a pair.
    Members take their turn as pivots in the order of one hash, so lists that share members tend to share pivots."""
    small = staged(nodes.filter(F.col("n") <= LIGHT).select("node", "n", "prefix", "light"), "light-sets")
    boundary = choose_boundary(small)
    place = F.col("place") < F.col("n") - F.ceil(8 * F.col("n") / 9) + 1
    heavy = nodes.filter(5 * F.col("n") >= 4 * (boundary + 1)).select("node", "n", F.posexplode("prefix").alias("place", "key")).select("key", "node", "n", "place", place.alias("core"))
    light = subset_keys(small, boundary).withColumns({"place": F.lit(0), "core": F.lit(True)})
    whole = Window.partitionBy("key")
    entries = heavy.union(light.select("key", "node", "n", "place", "core"))
    entries = entries.withColumn("members", F.count("*").over(whole)).filter("members > 1").withColumn("hash", F.xxhash64("node"))
    ordered = whole.orderBy("hash", "node")
    entries = entries.withColumns({"turn": F.row_number().over(ordered) - 1, "pivot": F.first("node").over(ordered), "pivot_n": F.first("n").over(ordered)})
    return entries.drop("hash")


def marked(keys: DataFrame) -> np.ndarray:
    """Bitmap of `MARKS` words with a bit for each hash in the column h."""
    bit = F.bit_or(F.expr("shiftleft(1L, cast(shiftright(h, 40) & 63 as int))"))
    found = keys.groupBy(F.col("h").bitwiseAND(F.lit(MARKS - 1)).alias("place")).agg(bit.alias("bits")).toArrow()
    table = np.zeros(MARKS, np.int64)
    table[found.column("place").to_numpy()] = found.column("bits").to_numpy()
    return table.view(np.uint64)


def links(pairs: DataFrame, sizes: DataFrame, docs: DataFrame, owners: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) that link, staged."""
    known = sizes.select("node", "n", F.when(F.size("wide") > 0, F.col("wide")).otherwise(F.col("short")))
    both = pairs.join(known.toDF("a", "n_a", "wide_a"), "a").join(known.toDF("b", "n_b", "wide_b"), "b")
    narrow = F.least(F.size("wide_a"), F.size("wide_b"))

    def folded(bits: str) -> Column:  # the wider of two parities has at most twice the words
        halves = F.zip_with(F.slice(bits, F.lit(1), narrow), F.slice(bits, narrow + 1, narrow), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bits) > narrow, halves).otherwise(F.col(bits))

    apart = F.aggregate(F.zip_with(folded("wide_a"), folded("wide_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = staged(both.filter(_close(F.col("n_a"), F.col("n_b")) & (9 * apart <= F.col("n_a") + F.col("n_b"))).select("a", "b"), "near-pairs")
    wanted = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    shared = docs.sparkSession.sparkContext.broadcast(marked(owners.join(wanted, "node", "left_semi").select(F.xxhash64("doc_id").alias("h"))))
    if not shared.value.any():
        return near

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy().view(np.uint64)
            bits = shared.value[h & np.uint64(MARKS - 1)] >> (h >> np.uint64(40) & np.uint64(63))
            yield batch.filter(pa.array(bits & np.uint64(1) == 1))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(chosen(batches)):
            _, hashes, n, node = sets_of(batch.column("text"))
            members = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(node), members], ["node", "members"])

    plain = docs.filter(F.col("doc_id").isNotNull()).select(F.xxhash64("doc_id").alias("h"), F.col("text").cast("string").alias("text"))
    held = plain.mapInArrow(sets, "node bigint, members array<bigint>").join(wanted, "node", "left_semi")
    held = staged(held.dropDuplicates(["node"]), "pair-sets")
    shared.destroy()
    full = near.join(held.toDF("a", "members_a"), "a").join(held.toDF("b", "members_b"), "b")
    both = full.select("a", "b", (F.size("members_a") + F.size("members_b")).alias("sum"), F.size(F.array_intersect("members_a", "members_b")).alias("shared"))
    found = staged(both.filter(100 * F.col("shared") >= 80 * (F.col("sum") - F.col("shared"))).select("a", "b"), "links")
    discard(near, held)
    return found


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _open(x: str, y: str) -> Column:
    """Whether sizes, parities and places of two rows leave it open that they link: before the first shingle that both
    sets hold, in the order of all, a set has no more shingles than it may lack in the other."""
    differ = reduce(add, (F.bit_count(F.col(f"{x}.p{k}").bitwiseXOR(F.col(f"{y}.p{k}"))) for k in range(WORDS64)))
    n_x, n_y = F.col(f"{x}.n"), F.col(f"{y}.n")
    early = (9 * (n_x - F.col(f"{x}.place")) >= 4 * (n_x + n_y)) & (9 * (n_y - F.col(f"{y}.place")) >= 4 * (n_x + n_y))
    return _close(n_x, n_y) & early & (9 * differ <= n_x + n_y)


def _apart(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries with their component, of the lists whose members are in more than one."""
    whole = Window.partitionBy("key")
    placed = entries.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return placed.withColumns({"low": F.min("component").over(whole), "high": F.max("component").over(whole)}).filter("low <> high").drop("low", "high")


def _pivot_pairs(placed: DataFrame, sizes: DataFrame, least: int, most: int) -> DataFrame:
    """Open pairs of a list's pivots, those whose turn is from `least` to below `most`, and the members with a later turn
    that are apart from them."""
    bits = sizes.select("node", *(F.col("short")[k].alias(f"p{k}") for k in range(WORDS64)))
    x = placed.join(bits, "node").alias("x")
    y = placed.filter((F.col("turn") >= least) & (F.col("turn") < most)).join(bits, "node").alias("y")
    smaller = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.node") < F.col("y.node")))
    core = F.when(smaller, F.col("x.core")).otherwise(F.col("y.core"))
    apart = (F.col("x.component") != F.col("y.component")) & (F.col("x.turn") > F.col("y.turn")) & core & _open("x", "y")
    return x.join(y, (F.col("x.key") == F.col("y.key")) & apart).select(*_pair(F.col("x.node"), F.col("y.node"))).distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (least doc_id reachable by links) of every row of `docs` (doc_id, text)."""
    whole = staged(described(docs), "shingle-sets")
    owned = whole.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    owners = staged(owned.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "set-owners")
    sizes = staged(owned.drop("doc_id").dropDuplicates(["node"]), "sets")
    rows = staged(whole.select("doc_id", "node", "n"), "document-sets")
    discard(whole)
    entries = staged(inverted_lists(sizes), "inverted-lists")

    first = entries.filter((F.col("turn") > 0) & _close(F.col("n"), F.col("pivot_n"))).select(*_pair(F.col("node"), F.col("pivot"))).distinct()
    first = staged(first, "pivot-pairs")
    found = links(first, sizes, docs, owners)
    discard(first)
    joined = components(found)
    left = entries.drop("pivot", "pivot_n").filter("members > 2")  # a list's first pivot has met all its members
    before, least, most = entries, 1, GROWTH
    while True:
        placed = staged(_apart(left, joined), "open-lists")
        discard(before)
        after = F.col("members") - least
        rest = placed.filter(f"turn >= {least}").agg(F.sum(after / 2).alias("pairs"), F.count("*").alias("entries"), F.max("members").alias("members")).first()
        if not rest["entries"]:
            break
        if rest["pairs"] <= FEW * rest["entries"]:
            most = rest["members"]
        pairs = staged(_pivot_pairs(placed, sizes, least, most), "pivot-pairs")
        more = links(pairs, sizes, docs, owners)
        discard(pairs)
        if more.limit(1).count():
            joined = components(joined.filter("node <> component").toDF("a", "b").union(more))
        left, before, least, most = placed.drop("component").filter(F.col("members") > most), placed, most, most * GROWTH
    discard(placed)

    placed = owners.join(joined, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = staged(placed.join(least, "component").select("node", "component_id"), "set-components")
    discard(owners, sizes)
    result = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("node")).alias("node")).join(by_node, "node", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` with the least id of each component; rows without an id stay, of rows with one id and text one stays."""
    found = staged(jaccard_components(docs), "document-components")
    leaders = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("times"))
    alone = docs.join(leaders.filter("times = 1"), "doc_id", "left_semi").select(docs.columns)
    repeated = docs.join(leaders.filter("times > 1"), "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return alone.union(repeated).union(docs.filter(F.col("doc_id").isNull()))


SQL = f"""
WITH RECURSIVE words AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents WHERE doc_id IS NOT NULL),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
shingle AS (SELECT doc_id, unnest(s) AS s, len(s) AS n FROM sets),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT a, b FROM pair UNION SELECT reach.a, pair.b FROM reach JOIN pair ON reach.b = pair.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id FROM sets LEFT JOIN least ON doc_id = a
"""
