"""Prefix trie of conversations by the Euler-tour technique.

Every distinct sequence of first turns is a node. A node is named by its smallest conversation and its depth, and found
by a fingerprint of its turns: the exclusive or of 128-bit hashes of (place, turn), so that prefixes come from running
sums over slices of a conversation and no conversation has to be in one task.

The tour of the tree has an arc into each node and one out of it. An arc's successor is known from the node's first
child, next sibling and parent. The tour is list-ranked: first each task contracts what follows one another among its
own arcs (dealt by ranges of conversations and depths); then, while more than `least` runs are left, coins decide which
runs swallow their successor; a bounded rest is ranked in one task; and what was contracted gets its places back in
reverse order. Running sums over the tour, in blocks of equal size, give at a node's two arcs the leaves and savings of
its subtree.

Turns are ordered by number (null first), repeated numbers by the MD5 of role and text; null roles and texts are empty;
rows without a conversation are left out; an empty table has no nodes. Extra columns are not looked at.

Hot keys: children of a node are linked in slices of about `SIBLINGS`. Nodes with so many children that there cannot be
more than `HOT` of them are sent to all tasks, other nodes are joined. Ids of the conversations that end at a node are
gathered by ranges; a digest over them is sequential, so one node's ids go through one task as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import order_key, skew_safe_rank
from .common import staged

SLICE, SIBLINGS, HOT, BLOCK = 1024, 1024, 10_000, 1 << 18
#: Arcs of a task that contracts, and runs that one task ranks.
TASK_ARCS, LEAST = 400_000, 100_000


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest and n_bytes of every turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "turns")
    order = order_key([(F.col("turn"), True, False), (F.col("digest"), False, False)], F.col("row"))
    return skew_safe_rank(rows, ["conv_id"], order, "place").select("conv_id", "place", "digest", "n_bytes")


def rebuilt(turns: DataFrame, share: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations whose first turns come from another one: the first h of the conversation at
    the start of each `share` ids, where h is the CRC-32 of the id modulo `most`, then their own after h."""
    turns = staged(turns, "placed")
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("head")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size"))
    convs = sizes.select("conv_id", "size", head, (F.col("conv_id") - F.col("conv_id") % share).alias("from_id"))
    convs = convs.join(sizes.select(F.col("conv_id").alias("from_id"), F.col("size").alias("there")), "from_id", "left")
    taken = F.least("head", F.coalesce("there", F.lit(0))).alias("taken")
    own = F.greatest(F.col("size") - F.col("head"), F.lit(0))
    convs = staged(convs.select("conv_id", "from_id", "size", "head", taken, (taken + own).alias("length")), "lengths")
    first = turns.filter((F.col("place") < most) & (F.col("conv_id") % share == 0)).withColumnRenamed("conv_id", "from_id")
    heads = first.join(convs.select("conv_id", "from_id", "taken"), "from_id").filter("place <= taken")
    sliced = lambda c: F.floor(c / F.lit(SLICE))
    rest = turns.filter(F.col("place") > head).withColumn("slice", sliced(F.col("place")))
    pieces = convs.filter("size > head").select("conv_id", "head", "taken", F.explode(F.sequence(sliced(F.col("head") + 1), sliced(F.col("size")))).alias("slice"))
    tails = rest.join(pieces, ["conv_id", "slice"]).withColumn("place", F.col("place") - F.col("head") + F.col("taken"))
    columns = "conv_id", "place", "digest", "n_bytes"
    return heads.select(*columns).unionByName(tails.select(*columns)), convs.select("conv_id", "length")


def _prefixes(turns: DataFrame) -> DataFrame:
    """Turns with the fingerprint (a, b) of the turns up to each, and that of the turns before it (pa, pb)."""
    term = lambda seed: F.xxhash64(F.lit(seed), "place", "digest")
    turns = turns.select("*", term(1).alias("ta"), term(2).alias("tb"), F.floor((F.col("place") - 1) / SLICE).alias("slice"))
    sums = turns.groupBy("conv_id", "slice").agg(F.bit_xor("ta").alias("sa"), F.bit_xor("tb").alias("sb"))
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "slice", F.bit_xor("sa").over(before).alias("sa"), F.bit_xor("sb").over(before).alias("sb")).filter("slice > 0")
    inside = Window.partitionBy("conv_id", "slice").orderBy("place")
    run = turns.select("*", F.bit_xor("ta").over(inside).alias("ia"), F.bit_xor("tb").over(inside).alias("ib"))
    run = run.join(sums, ["conv_id", "slice"], "left")
    a, b = (F.col(f"i{x}").bitwiseXOR(F.coalesce(f"s{x}", F.lit(0))) for x in "ab")
    return run.select("conv_id", "place", "n_bytes", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("ta")).alias("pa"), b.bitwiseXOR(F.col("tb")).alias("pb"))


def _nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each node: conv_id, depth, n_convs, n_bytes, its fingerprint and its parent's, n_children, first."""
    grown = turns.groupBy("a", "b", F.col("place").alias("depth")).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.max("pa").alias("pa"), F.max("pb").alias("pb")
    )
    nothing = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(nothing.alias("a"), nothing.alias("b"), nothing.alias("depth"), "conv_id", "n_convs", nothing.alias("n_bytes"), nothing.alias("pa"), nothing.alias("pb"))
    nodes = staged(grown.unionByName(root), "nodes")
    below = nodes.filter("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"), (F.col("depth") - 1).alias("depth"))
    below = below.agg(F.count("*").alias("n_children"), F.min("conv_id").alias("first"))
    return staged(nodes.join(below, ["a", "b", "depth"], "left").fillna(0, ["n_children"]), "counted-nodes")


def _linked(nodes: DataFrame, siblings: int, hot: int) -> DataFrame:
    """Nodes with parent_conv_id, the next sibling (null: none) and the first child in the order of siblings."""
    up = nodes.filter("n_children > 0").select(F.col("a").alias("pa"), F.col("b").alias("pb"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_siblings"))
    many = max(siblings, nodes.count() // hot)  # so that fewer than `hot` nodes have more children
    sent = F.broadcast(up.filter(F.col("n_siblings") > many))
    keys = ["pa", "pb", "depth"]
    kids = nodes.filter("depth > 0")
    kids = kids.join(sent, keys).unionByName(kids.join(sent, keys, "left_anti").join(up.filter(F.col("n_siblings") <= many), keys).select(kids.join(sent, keys).columns))
    bucket = F.pmod(F.xxhash64("conv_id"), F.ceil(F.col("n_siblings") / siblings)).alias("bucket")
    kids = staged(kids.select("conv_id", "depth", "n_convs", "n_bytes", "a", "b", "n_children", "first", "parent_conv_id", "n_siblings", bucket), "children")
    parent = ["parent_conv_id", "depth"]
    following = kids.withColumn("next", F.lead("conv_id").over(Window.partitionBy(*parent, "bucket").orderBy("conv_id")))
    tops = kids.filter(F.col("n_siblings") > siblings).groupBy(*parent, "bucket").agg(F.min("conv_id").alias("top"))
    jump = tops.withColumn("jump", F.lead("top").over(Window.partitionBy(*parent).orderBy("bucket")))
    last = following.filter((F.col("n_siblings") > siblings) & F.col("next").isNull()).join(jump, [*parent, "bucket"]).withColumn("next", F.col("jump"))
    linked = following.filter((F.col("n_siblings") <= siblings) | F.col("next").isNotNull()).unionByName(last.select(following.columns))
    columns = ["conv_id", "depth", "n_convs", "n_bytes", "a", "b", "n_children", "first", "parent_conv_id", "next"]
    root = nodes.filter("depth = 0").withColumns({"parent_conv_id": F.lit(None).cast("long"), "next": F.lit(None).cast("long")})
    linked = linked.select(columns).unionByName(root.select(columns))
    begin = tops.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.min_by("top", "bucket").alias("begin"))
    return linked.join(begin, ["conv_id", "depth"], "left").withColumn("first", F.coalesce("begin", "first")).drop("begin")


def _arcs(nodes: DataFrame) -> DataFrame:
    """Arcs (conv_id, code) with code = 2 * depth for the way in and one more for the way out, their successors (to_id,
    to_code; null after the last) and weights: a leaf and the savings of a node count on the way in."""
    code, none = F.col("depth") * 2, F.lit(0).cast("long")
    leaf = F.col("n_children") == 0
    saved = (F.col("n_convs") - 1) * F.col("n_bytes")
    enter = F.struct(code.alias("code"), F.when(leaf, F.col("conv_id")).otherwise(F.col("first")).alias("to_id"), F.when(leaf, code + 1).otherwise(code + 2).alias("to_code"), leaf.cast("long").alias("leaf"), saved.alias("saved"))
    to_code = F.when(F.col("next").isNotNull(), code).when(F.col("depth") > 0, code - 1)
    leave = F.struct((code + 1).alias("code"), F.coalesce("next", "parent_conv_id").alias("to_id"), to_code.alias("to_code"), none.alias("leaf"), none.alias("saved"))
    return nodes.select("conv_id", F.inline(F.array(enter, leave)))


def _places(own: np.ndarray, to: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows of (id, code) and their successors: the index of the first row of each one's run, the sizes before it
    in the run, and whether it ends its run. Pointers to the row before are doubled until all are at the start."""
    kind = np.dtype([("id", np.int64), ("code", np.int64)])
    own, to = (np.ascontiguousarray(x).view(kind)[:, 0] for x in (own, to))
    order = np.argsort(own)
    at = np.searchsorted(own, to, sorter=order).clip(max=len(own) - 1)
    after = np.where(own[order[at]] == to, order[at], -1)
    before = np.arange(len(own))
    before[after[after >= 0]] = np.flatnonzero(after >= 0)
    gone = np.where(before != np.arange(len(own)), size[before], 0)
    while not np.array_equal(ahead := before[before], before):
        gone, before = gone + gone[before], ahead
    return before, gone, after < 0


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arcs of a task with the first arc of their run (run_id, run_code), their place in it, and whether it ends there."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches).combine_chunks()
    get = lambda c: table.column(c).fill_null(-1).to_numpy()
    own, to = np.stack([get("conv_id"), get("code")], 1), np.stack([get("to_id"), get("to_code")], 1)
    start, place, last = _places(own, to, np.ones(len(own), np.int64))
    added = {"run_id": own[start, 0], "run_code": own[start, 1], "place": place, "last": last}
    for name, values in added.items():
        table = table.append_column(name, pa.array(values))
    yield from table.to_batches(max_chunksize=1 << 16)


def _rank_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    get = lambda c: table.column(c).fill_null(-1).to_numpy()
    own, to = np.stack([get("run_id"), get("run_code")], 1), np.stack([get("to_id"), get("to_code")], 1)
    _, place, _ = _places(own, to, get("size"))
    yield pa.RecordBatch.from_arrays([pa.array(own[:, 0]), pa.array(own[:, 1]), pa.array(place)], ["run_id", "run_code", "start"])


RANKED = "run_id long, run_code long, start long"


def list_rank(runs: DataFrame, least: int = LEAST) -> DataFrame:
    """The place at which each run of one list starts: run_id, run_code, start. Input: run_id, run_code, to_id, to_code, size.

    In each round a run swallows its successor if its own coin shows heads and the other's tails, about a quarter of
    them; so there are as many rounds as the logarithm of the length, on ever fewer rows.
    """
    swallowed: list[DataFrame] = []
    while runs.count() > least:
        coin = lambda x, y, turn=len(swallowed): F.xxhash64(F.lit(turn), x, y) % 2 == 0
        takes = F.col("to_id").isNotNull() & coin("run_id", "run_code") & ~coin("to_id", "to_code")
        up = F.when(takes, F.struct("run_id", "run_code", "size"))
        own = F.when(~takes, F.struct("to_id", "to_code", "size"))
        key_id, key_code = (F.when(takes, F.col(f"to_{x}")).otherwise(F.col(f"run_{x}")) for x in ("id", "code"))
        met = runs.select(key_id.alias("id"), key_code.alias("code"), up.alias("up"), own.alias("own"))
        met = staged(met.groupBy("id", "code").agg(F.max("up").alias("up"), F.max("own").alias("own")), "runs")
        swallowed.append(met.filter("up IS NOT NULL").select("id", "code", "up.run_id", "up.run_code", "up.size"))
        head = lambda x: F.coalesce(f"up.run_{x}", x).alias(f"run_{x}")
        runs = met.select(head("id"), head("code"), "own.to_id", "own.to_code", (F.coalesce("up.size", F.lit(0)) + F.col("own.size")).alias("size"))
    ranked = staged(runs.repartition(1).mapInArrow(_rank_rest, RANKED), "ranks")
    for gone in reversed(swallowed):
        back = gone.join(ranked, ["run_id", "run_code"]).select(F.col("id").alias("run_id"), F.col("code").alias("run_code"), (F.col("start") + F.col("size")).alias("start"))
        ranked = staged(ranked.unionByName(back), "ranks")
    return ranked


def _subtree_sums(arcs: DataFrame, task_arcs: int, least: int, block: int) -> DataFrame:
    """conv_id, depth, n_leaves and saved_tokens from running sums along the tour."""
    arcs = staged(arcs, "arcs")
    n = max(int(arcs.sparkSession.conf.get("spark.sql.shuffle.partitions")), arcs.count() // task_arcs + 1)
    dealt = arcs.repartition(n, F.shiftright("conv_id", 8), F.shiftright("code", 11))
    kinds = ", ".join(f"{f.name} long" for f in arcs.schema.fields)
    runs = staged(dealt.mapInArrow(_contract, f"{kinds}, run_id long, run_code long, place long, last boolean"), "contracted")
    ranked = list_rank(runs.filter("last").select("run_id", "run_code", "to_id", "to_code", (F.col("place") + 1).alias("size")), least)
    tour = runs.join(ranked, ["run_id", "run_code"]).select("conv_id", "code", "leaf", "saved", (F.col("start") + F.col("place")).alias("at"))
    tour = staged(tour.withColumn("block", F.floor(F.col("at") / block)), "tour")
    totals = tour.groupBy("block").agg(F.sum("leaf").alias("l"), F.sum("saved").alias("s"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("block", F.coalesce(F.sum("l").over(earlier), F.lit(0)).alias("l"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s"))
    inside = Window.partitionBy("block").orderBy("at")
    run = tour.select("*", F.sum("leaf").over(inside).alias("rl"), F.sum("saved").over(inside).alias("rs")).join(starts, "block")
    gain = lambda x, w: F.sum(F.when(F.col("code") % 2 == 1, F.col(f"r{x}") + F.col(x)).otherwise(F.col(w) - F.col(f"r{x}") - F.col(x)))
    found = run.groupBy("conv_id", F.floor(F.col("code") / 2).alias("depth"))
    return found.agg(gain("l", "leaf").alias("n_leaves"), gain("s", "saved").alias("saved_tokens"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node; rows come in order, and only one state is kept."""
    out: list[tuple] = []
    key, state = None, None
    for batch in batches:
        for a, b, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "depth", "ids")), strict=True):
            if key == (a, b, depth):
                state.update(b"," + ids.encode())
            else:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (a, b, depth), hashlib.sha256(ids.encode())
        if len(out) > 1 << 14:
            yield _digest_rows(out)
            out = []
    if key:
        yield _digest_rows([*out, (*key, state.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["a", "b", "depth", "ends_sha256"])


def _ends(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """a, b, depth and ends_sha256 of the nodes at which conversations end; ids are gathered 128 at most in a row."""
    at = turns.select("conv_id", F.col("place").alias("depth"), "a", "b").join(convs.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"])
    nothing = F.lit(0).cast("long")
    at = at.unionByName(convs.filter("length = 0").select("conv_id", nothing.alias("depth"), nothing.alias("a"), nothing.alias("b")))
    ids = at.groupBy("a", "b", "depth", F.shiftright("conv_id", 7).alias("range")).agg(F.concat_ws(",", F.array_sort(F.collect_list("conv_id"))).alias("ids"))
    return ids.repartition("a", "b", "depth").sortWithinPartitions("a", "b", "depth", "range").mapInArrow(_digests, "a long, b long, depth long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, siblings: int = SIBLINGS, hot: int = HOT, task_arcs: int = TASK_ARCS, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """One row for each node of the trie of `turns` (conv_id, place, digest, n_bytes); `convs` has each conversation's length."""
    turns = staged(_prefixes(turns), "prefixes")
    nodes = staged(_linked(_nodes(turns, convs), siblings, hot), "linked")
    sums = _subtree_sums(_arcs(nodes), task_arcs, least, block)
    found = nodes.join(sums, ["conv_id", "depth"]).join(_ends(turns, convs), ["a", "b", "depth"], "left")
    none = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", none)


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    return prefix_trie(*rebuilt(ordered_turns(conversations)))


SQL = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c FROM range(256) AS r(n))),
turn AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
size AS (SELECT conv_id, count(*) AS n FROM turn GROUP BY conv_id),
conv AS (
  SELECT conv_id, n, from_id, h, least(h, coalesce((SELECT s.n FROM size s WHERE s.conv_id = from_id), 0)) AS taken
  FROM (
    SELECT conv_id, n, conv_id - conv_id % 5 AS from_id, xor(list_reduce(
      [4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
      lambda c, k: xor(c >> 8, t[(xor(c, k) & 255) + 1])), 4294967295) % 9 AS h
    FROM size, crc_table)),
built AS (
  SELECT c.conv_id, t.place, t.role, t.text FROM conv c JOIN turn t ON t.conv_id = c.from_id AND t.place <= c.taken
  UNION ALL SELECT c.conv_id, t.place - h + taken, t.role, t.text FROM conv c JOIN turn t USING (conv_id) WHERE t.place > h),
prefix AS (
  SELECT conv_id, place AS depth, octet_length(encode(text)) AS bytes,
    md5(string_agg(length(role) || ':' || length(text) || ':' || role || text, '' ORDER BY place)
      OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)) AS key
  FROM built
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM conv),
long_as AS (SELECT conv_id, max(depth) AS length FROM prefix GROUP BY conv_id),
node AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM prefix GROUP BY key, depth),
up AS (
  SELECT node.key, node.depth, parent.key AS parent_key, parent.conv_id AS parent_conv_id
  FROM node JOIN prefix p ON p.conv_id = node.conv_id AND p.depth = node.depth - 1 JOIN node parent ON parent.key = p.key AND parent.depth = p.depth),
kids AS (SELECT parent_key AS key, depth - 1 AS depth, count(*) AS n_children FROM up GROUP BY 1, 2),
sums AS (
  SELECT p.key, p.depth, sum(CASE WHEN kids.key IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((node.n_convs - 1) * node.bytes) AS saved
  FROM node JOIN prefix p ON p.conv_id = node.conv_id AND p.depth <= node.depth LEFT JOIN kids ON kids.key = node.key AND kids.depth = node.depth
  GROUP BY p.key, p.depth),
ends AS (
  SELECT key, depth, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
  FROM prefix JOIN long_as USING (conv_id) WHERE depth = length GROUP BY key, depth)
SELECT node.conv_id, node.depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
  coalesce(sha, sha256('')) AS ends_sha256
FROM node LEFT JOIN up ON up.key = node.key AND up.depth = node.depth LEFT JOIN kids ON kids.key = node.key AND kids.depth = node.depth
JOIN sums ON sums.key = node.key AND sums.depth = node.depth LEFT JOIN ends ON ends.key = node.key AND ends.depth = node.depth
"""
