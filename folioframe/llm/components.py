"""Connected components of a graph given by its edges, as tables: no edge or label list reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged

#: Edges that one task contracts at a time.
CHUNK = 1_000_000


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, least member) of the components that the edges make, by hooking and pointer jumping."""
    names, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = codes[: len(a)], codes[len(a) :]
    root = np.arange(len(names))
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    other = root != np.arange(len(names))
    return names[other], names[root[other]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        both = pa.Table.from_batches(held)
        stars = contracted(both.column(0).to_numpy(), both.column(1).to_numpy())
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(x) for x in stars], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= CHUNK:
            yield flush()
    if held:
        yield flush()


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of every node of `edges` (a, b long); lone nodes are not in it.

    Each task first contracts its own edges to stars. Then every node takes the least label among its neighbours and
    jumps to the label of its label, until nothing changes.
    """
    stars = edges.select("a", "b").mapInArrow(_contract, "a bigint, b bigint")
    both = staged(stars.union(stars.select("b", "a")).distinct(), "component-edges")
    labels = current = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), "component-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        better = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        moved = staged(better.join(jump, "component").select("node", "old", F.least("component", "far").alias("component")), "component-labels")
        discard(current)
        current, labels = moved, moved.select("node", "component")
        if not moved.filter("component <> old").limit(1).count():
            discard(both)
            return labels
