"""Near copies among embeddings by hierarchical navigable small-world graphs, one for each shard of a label.

Vectors are compared only within a label (and a dimension). Equal vectors become one node with a multiplicity, nodes of
a label are dealt to shards of about `SHARD`, and each shard's graph is built once, in layers of which each holds an
eighth of the one below. Every node queries every shard of its label: each unordered pair of shards is one row of work,
searched both ways. A beam search walks down the layers; queries drawn by hash are also compared with all vectors of
the shard, until those that the beams settle have shown `LINKS` links, and beams double until they find at least
`RECALL` of these. Where all queries together have fewer links, all of them have been compared with the whole shard. A
query whose beam holds nothing but links is searched again with a wider one, so no group of links is cut off; each such
round is audited anew among its own queries. A beam as wide as the shard means comparing with all of it.

Every pair found is verified by its cosine in double precision. A pair of shards returns counts of links and a spanning
forest of them, never all pairs of a group; the forests of all pairs are united to components.

Vectors that are null, empty, zero or hold null or non-finite components, and those without a label, link with nothing.
Rows without an id have no component, link with nothing and are kept. Repeated rows count as vectors of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, staged
from .components import components, contracted

THRESHOLD = 0.93
SHARD = 8192
RECALL = 0.98
LINKS = 256
DEGREE = 24
BLOCK = 256


def beam(vectors: np.ndarray, near: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The `width` best nodes found for each query (-1 where fewer) and their cosines; all queries step together."""
    n, q = len(vectors), len(queries)
    width = min(width, n)
    seen = np.zeros((q, n), bool)
    ids = np.full((q, width), -1, np.int64)
    score = np.full((q, width), -np.inf)
    done = np.ones((q, width), bool)
    rows = np.arange(q)
    ids[:, 0], score[:, 0], done[:, 0] = entry, np.einsum("qd,qd->q", queries, vectors[entry]), False
    seen[rows, entry] = True
    while True:
        open_score = np.where(done, -np.inf, score)
        active = np.flatnonzero(open_score.max(axis=1) > -np.inf)
        if not len(active):
            return ids, score
        step = min(4, width)
        picked = np.argpartition(-open_score[active], step - 1, axis=1)[:, :step]
        fine = np.take_along_axis(open_score[active], picked, axis=1) > -np.inf
        done[active[:, None], picked] = True
        around = near[np.where(fine, ids[active[:, None], picked], 0)]
        around = np.where(fine[:, :, None], around, -1).reshape(len(active), -1)
        around.sort(axis=1)
        around[:, 1:][around[:, 1:] == around[:, :-1]] = -1
        fresh = (around >= 0) & ~seen[active[:, None], around]
        some, at = np.nonzero(fresh)
        found = around[some, at]
        seen[active[some], found] = True
        new = np.full(around.shape, -np.inf)
        new[some, at] = np.einsum("kd,kd->k", queries[active[some]], vectors[found])
        all_ids = np.concatenate([ids[active], around], axis=1)
        all_score = np.concatenate([score[active], new], axis=1)
        all_done = np.concatenate([done[active], ~fresh], axis=1)
        best = np.argpartition(-all_score, width - 1, axis=1)[:, :width]
        ids[active] = np.take_along_axis(all_ids, best, axis=1)
        score[active] = np.take_along_axis(all_score, best, axis=1)
        done[active] = np.take_along_axis(all_done, best, axis=1)


def chosen_neighbours(vectors: np.ndarray, queries: np.ndarray, ids: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` neighbours of each query, nearest first, each nearer to the query than to those before it; what is
    left over fills the rest, so that groups of near copies keep their ways out."""
    order = np.argsort(-score, axis=1, kind="stable")
    ids, score = np.take_along_axis(ids, order, axis=1), np.take_along_axis(score, order, axis=1)
    q, width = ids.shape
    kept = np.zeros((q, width), bool)
    count = np.zeros(q, np.int64)
    points = vectors[np.maximum(ids, 0)]
    for k in range(width):
        between = np.einsum("qd,qjd->qj", points[:, k], points[:, :k]) if k else np.zeros((q, 0))
        blocked = (kept[:, :k] & (between >= score[:, k : k + 1])).any(axis=1)
        good = (ids[:, k] >= 0) & ~blocked & (count < most)
        kept[:, k] = good
        count += good
    first = np.argsort(np.where(ids < 0, 2, np.where(kept, 0, 1)), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, first, axis=1)


def layer(vectors: np.ndarray, members: np.ndarray, beam_width: int = 48) -> np.ndarray:
    """Neighbours (n x DEGREE, -1 behind the last) of the members of a layer, which are inserted in growing batches."""
    near = np.full((len(vectors), DEGREE), -1, np.int64)
    filled = np.zeros(len(vectors), np.int64)
    start = members[: min(len(members), DEGREE + 1)]
    for v in start:
        others = start[start != v]
        near[v, : len(others)], filled[v] = others, len(others)
    at = len(start)
    while at < len(members):
        batch = members[at : at + min(BLOCK, at)]
        ids, score = beam(vectors, near, vectors[batch], np.full(len(batch), members[0]), beam_width)
        links = chosen_neighbours(vectors, vectors[batch], ids, score, DEGREE // 2)
        for v, row in zip(batch.tolist(), links.tolist(), strict=True):
            row = [x for x in row if x >= 0]
            near[v, : len(row)], filled[v] = row, len(row)
            for x in row:
                if filled[x] < DEGREE:
                    near[x, filled[x]] = v
                    filled[x] += 1
                else:  # a full list: the new one joins the choice
                    options = np.append(near[x], v)[None, :]
                    best = chosen_neighbours(vectors, vectors[x : x + 1], options, (vectors[options[0]] @ vectors[x])[None, :], DEGREE)[0]
                    near[x], filled[x] = best, DEGREE
        at += len(batch)
    return near


def build(vectors: np.ndarray, keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers of the graph, lowest first: members and their neighbours. A node's height follows from the hash of its key."""
    draw = mixed(keys.astype(np.int64).view(np.uint64))
    out, members = [], np.arange(len(vectors))
    level = 0
    while len(members):
        out.append((members, layer(vectors, members)))
        level += 1
        members = members[(draw[members] >> np.uint64(64 - 3 * level)) == 0] if level < 20 else members[:0]
    return out


def search(vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    entry = np.full(len(queries), layers[-1][0][0])
    for _, near in layers[:0:-1]:
        ids, score = beam(vectors, near, queries, entry, 4)
        entry = ids[np.arange(len(queries)), score.argmax(axis=1)]
    return beam(vectors, layers[0][1], queries, entry, width)


def links_of(
    vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, keys: np.ndarray, threshold: float, same: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) that may link, by beams widened until the audit passes and no beam is full of links. With
    `same` the queries are the vectors, and none links with itself."""
    near_enough = threshold - 1e-9
    n = len(vectors)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def compared(rows: np.ndarray) -> np.ndarray:
        """Numbers of all links of some queries, which go to the pairs found."""
        good = queries[rows] @ vectors.T >= near_enough
        if same:
            good[np.arange(len(rows)), rows] = False
        some, at = np.nonzero(good)
        a.append(rows[some])
        b.append(at)
        return good.sum(axis=1)

    def searched(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes in the beams, which of them link, and whether a beam holds nothing else."""
        ids, score = search(vectors, layers, queries[rows], width)
        good = score >= near_enough
        return ids, good & (ids != rows[:, None]) if same else good, good.all(axis=1)

    left, width = np.argsort(mixed(keys.astype(np.int64).view(np.uint64))), 32
    while len(left):
        full, hits, cut = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        while len(full) < len(left) and width < n:
            if full.sum() < LINKS or len(hits) == len(full):
                full = np.concatenate([full, compared(left[len(full) : len(full) + BLOCK])])
            if full.sum() < LINKS:
                continue
            for k in range(len(hits), len(full), BLOCK):
                _, good, wide = searched(left[k : min(k + BLOCK, len(full))])
                hits, cut = np.concatenate([hits, good.sum(axis=1)]), np.concatenate([cut, wide])
            if full[~cut].sum() < LINKS:  # what is cut is audited in its own round
                continue
            if np.minimum(hits, full)[~cut].sum() >= RECALL * full[~cut].sum():
                break
            width *= 2
            hits, cut = hits[:0], cut[:0]
        rest, again = left[len(full) :], [left[:0]]  # those drawn are settled
        for k in range(0, len(rest), BLOCK):
            rows = rest[k : k + BLOCK]
            if width >= n:
                compared(rows)
                continue
            ids, good, wide = searched(rows)
            again.append(rows[wide])
            some, at = np.nonzero(good & ~wide[:, None])
            a.append(rows[some])
            b.append(ids[some, at])
        left = np.concatenate(again)
        width *= 4
    return np.concatenate(a), np.concatenate(b)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _levelled(x: np.ndarray) -> np.ndarray:
    """Vectors divided by the power of two of their largest component: exact, and no product overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = _levelled(x)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def graphs(nodes: DataFrame) -> DataFrame:
    """One row for each shard: its keys, multiplicities, vectors and graph, as bytes."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        keys = group.column("node").to_numpy().astype(np.int64)
        raw = _matrix(group.column("vector").combine_chunks())
        layers = build(_unit(raw), keys)
        return pa.table({
            "label": group.column("label").slice(0, 1), "dim": group.column("dim").slice(0, 1), "shard": group.column("shard").slice(0, 1),
            "keys": pa.array([keys.tobytes()]), "times": pa.array([group.column("times").to_numpy().astype(np.int64).tobytes()]), "vectors": pa.array([raw.tobytes()]),
            "members": pa.array([[m.astype(np.int32).tobytes() for m, _ in layers]]), "near": pa.array([[x.astype(np.int32)[m].tobytes() for m, x in layers]]),
        })

    schema = "label string, dim int, shard int, keys binary, times binary, vectors binary, members array<binary>, near array<binary>"
    return nodes.groupBy("label", "dim", "shard").applyInArrow(run, schema)


def _loaded(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    keys = np.frombuffer(row[f"keys_{side}"], np.int64)
    raw = np.frombuffer(row[f"vectors_{side}"], np.float64).reshape(len(keys), -1)
    layers = []
    for members, near in zip(row[f"members_{side}"], row[f"near_{side}"], strict=True):
        m = np.frombuffer(members, np.int32).astype(np.int64)
        full = np.full((len(keys), DEGREE), -1, np.int64)
        full[m] = np.frombuffer(near, np.int32).reshape(len(m), DEGREE)
        layers.append((m, full))
    return keys, np.frombuffer(row[f"times_{side}"], np.int64), raw, layers


def shard_links(row: dict, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes with links and their numbers of links, and a spanning forest of the links, of one pair of shards."""
    keys_x, times_x, raw_x, layers_x = _loaded(row, "x")
    keys_y, times_y, raw_y, layers_y = (keys_x, times_x, raw_x, layers_x) if same else _loaded(row, "y")
    unit_x, unit_y = _unit(raw_x), _unit(raw_y)
    a, b = links_of(unit_y, layers_y, unit_x, keys_x, threshold, same)  # x asks y
    if same:
        a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
    else:
        d, c = links_of(unit_x, layers_x, unit_y, keys_y, threshold)  # y asks x
        a, b = np.concatenate([a, c]), np.concatenate([b, d])
    pairs = np.unique(a * len(keys_y) + b)
    a, b = pairs // len(keys_y), pairs % len(keys_y)
    keep = np.zeros(len(a), bool)
    level_x = _levelled(raw_x)
    level_y = level_x if same else _levelled(raw_y)
    for k in range(0, len(a), 65536):  # the decision: cosine in double precision
        x, y = level_x[a[k : k + 65536]], level_y[b[k : k + 65536]]
        keep[k : k + 65536] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))) >= threshold
    a, b = a[keep], b[keep]
    ids = np.concatenate([keys_x[a], keys_y[b]])
    n = np.concatenate([times_y[b], times_x[a]])
    nodes, where = np.unique(ids, return_inverse=True)
    forest = contracted(keys_x[a], keys_y[b])
    return nodes, np.bincount(where, weights=n, minlength=len(nodes)).astype(np.int64), *forest


def near_copies(vectors: DataFrame, threshold: float = THRESHOLD, shard: int = SHARD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `vectors` (vec_id, embedding, label)."""
    plain = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string").alias("label"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    sound = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & finite, F.lit(False))
    rows = staged(plain.withColumn("sound", sound).withColumn("digest", F.when(sound, F.sha2(F.concat_ws(",", F.col("vector").cast("array<string>")), 256))), "vectors")
    grouped = rows.filter("sound").groupBy("label", "digest").agg(F.min(F.struct("vec_id", "vector")).alias("first"), F.count("*").alias("times"))
    nodes = grouped.select("label", "digest", F.col("first.vec_id").alias("node"), F.col("first.vector").alias("vector"), F.size("first.vector").alias("dim"), "times")
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    nodes = staged(nodes.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int")), "vector-nodes")
    built = staged(graphs(nodes.select("label", "dim", "shard", "node", "times", "vector")), "vector-graphs")
    x = built.select("label", "dim", F.col("shard").alias("x"))
    y = built.select("label", "dim", F.col("shard").alias("y"))
    pairs = x.join(y, ["label", "dim"]).filter("x <= y")
    fields = ("keys", "times", "vectors", "members", "near")
    side = lambda s: built.select("label", "dim", F.col("shard").alias(s), *(F.col(f).alias(f"{f}_{s}") for f in fields))
    work = pairs.repartition(F.xxhash64("label", "dim", "x", "y")).join(side("x"), ["label", "dim", "x"]).join(side("y"), ["label", "dim", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                nodes_, n, a, b = shard_links(row, row["x"] == row["y"], threshold)
                none = pa.nulls(len(nodes_), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(nodes_), pa.array(n), none, none], ["node", "n", "a", "b"])
                none = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(a), pa.array(b)], ["node", "n", "a", "b"])

    found = staged(work.mapInArrow(run, "node bigint, n bigint, a bigint, b bigint"), "vector-links")
    counts = found.filter("node is not null").groupBy("node").agg(F.sum("n").alias("n"))
    joined = components(found.filter("a is not null").select("a", "b"))
    placed = nodes.select("label", "digest", "node", "times").join(counts, "node", "left").join(joined, "node", "left")
    placed = placed.select("label", "digest", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    out = rows.select("vec_id", "label", "digest").join(placed, ["label", "digest"], "left")
    component = F.coalesce("component_id", "vec_id").alias("component_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
