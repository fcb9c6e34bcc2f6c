"""Row numbers and running numbers that hold when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_ROWS = 250_000


def order_key(order: Sequence[tuple[Column, bool, bool]], unique: Column) -> Column:
    """Sort terms as one comparable struct. A term is (numeric or string column, nulls first?, descending?).

    A descending term must be numeric; it is negated.
    """
    fields: list[Column] = []
    for i, (term, nulls_first, descending) in enumerate(order):
        fields.append((term.isNotNull() if nulls_first else term.isNull()).alias(f"n{i}"))
        fields.append((-term if descending else term).alias(f"v{i}"))
    return F.struct(*fields, unique.alias("u"))


def skew_safe_rank(rows: DataFrame, keys: Sequence[str], key_order: Column, name: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """`row_number` per key group, however large the group; planning it runs nothing.

    Each group is cut into ordered slices of about `slice_rows` rows, rows are numbered slice by slice, and a row's
    number is its number in its slice plus the sizes of the slices before. Cut points are a hashed sample of the group's
    own sort keys; the sample sets the balance, never the result. Only groups that have a cut are counted, so the slice
    sizes are few, and most groups are one slice.
    """
    keyed = rows.withColumn("_order", key_order)
    renamed = [f"_key{i}" for i in range(len(keys))]
    aside = lambda frame, *more: frame.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed)], *more)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in zip(keys, renamed)])
    drawn = F.pmod(F.xxhash64("_order"), F.lit(slice_rows)) == 0
    cuts = aside(keyed.filter(drawn).groupBy(*keys).agg(F.array_sort(F.collect_set("_order")).alias("_cuts")), "_cuts")
    passed = F.size(F.filter("_cuts", lambda cut: cut < F.col("_order")))
    cut = lambda how: keyed.join(cuts, same, how).withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(passed)).drop(*renamed, "_cuts")
    counted = cut("inner").groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_m"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = aside(counted.withColumn("_before", F.sum("_m").over(before)).filter("_before > 0"), F.col("_slice").alias("_at"), "_before")
    inside = cut("left").withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy("_order")))
    ranked = inside.join(offsets, same & (F.col("_slice") == F.col("_at")), "left")
    number = (F.col("_rn") + F.coalesce("_before", F.lit(0))).cast("bigint")
    return ranked.withColumn(name, number).select(*rows.columns, name)


BUCKET_BITS = 20


def number_ids(ids: DataFrame, id_col: str, name: str) -> DataFrame:
    """0-based place of each distinct id in id order.

    Places are counted inside buckets of 2^20 ids; a bucket's start comes from running sums over
    bucket counts, themselves bucketed once more, so no window sees more than about 2^20 rows.
    """
    low = F.shiftright(F.col(id_col), BUCKET_BITS)
    ids = ids.select(id_col).distinct().withColumn("_low", low)
    counts = ids.groupBy("_low").agg(F.count(F.lit(1)).alias("_n")).withColumn("_high", F.shiftright("_low", BUCKET_BITS))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    tops = counts.groupBy("_high").agg(F.sum("_n").alias("_t"))
    tops = tops.withColumn("_top", F.coalesce(F.sum("_t").over(earlier(Window.partitionBy(F.lit(0)).orderBy("_high"))), F.lit(0)))
    within = F.coalesce(F.sum("_n").over(earlier(Window.partitionBy("_high").orderBy("_low"))), F.lit(0))
    starts = counts.withColumn("_in", within).join(tops, "_high").select("_low", (F.col("_in") + F.col("_top")).alias("_start"))
    placed = ids.withColumn("_rn", F.row_number().over(Window.partitionBy("_low").orderBy(id_col)) - 1)
    return placed.join(starts, "_low").select(id_col, (F.col("_rn") + F.col("_start")).cast("bigint").alias(name))


def chunk_ids(ids: DataFrame, id_col: str, size: int) -> DataFrame:
    """Groups of `size` ids in id order, numbered from 0."""
    placed = number_ids(ids, id_col, "_place")
    return placed.select(id_col, F.floor(F.col("_place") / size).cast("bigint").alias("chunk"))


def _merge_runs(pieces: DataFrame, bits: int) -> DataFrame:
    """Joins touching pieces whose starts share a bucket of 2^bits ids; `bits` of 0 means one bucket."""
    bucket = F.shiftright("lo", bits) if bits else F.lit(0).cast("bigint")
    in_order = Window.partitionBy("_b").orderBy("lo")
    opens = F.coalesce((F.lag("hi").over(in_order) + 1 < F.col("lo")).cast("int"), F.lit(1))
    grouped = pieces.withColumn("_b", bucket).withColumn("_new", opens)
    grouped = grouped.withColumn("_run", F.sum("_new").over(in_order))
    merged = grouped.groupBy("_b", "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    if not bits:
        return merged.select("lo", "hi", F.lit(False).alias("_edge"))
    first, size = F.shiftleft(F.col("_b"), bits), 1 << bits
    edge = (F.col("lo") == first) | (F.col("hi") >= first + (size - 1))
    return merged.select("lo", "hi", edge.alias("_edge"))


def islands_of_ids(ids: DataFrame, id_col: str, bits: int = BUCKET_BITS) -> DataFrame:
    """Runs of consecutive ids. Runs are found per bucket; only runs at a bucket edge go one level up."""
    pieces = ids.select(F.col(id_col).cast("bigint").alias("lo")).distinct().withColumn("hi", F.col("lo"))
    closed = []
    for level in (bits, 2 * bits, 0):
        merged = _merge_runs(pieces, level)
        closed.append(merged.filter(~F.col("_edge")).select("lo", "hi"))
        pieces = merged.filter("_edge").select("lo", "hi")
    runs = reduce(DataFrame.unionByName, closed)
    size = F.col("hi") - F.col("lo") + 1
    short = F.when(size == 1, F.col("lo").cast("string")).otherwise(F.concat_ws(" ", "lo", "hi"))
    return runs.select(
        F.col("lo").alias("first_id"),
        F.col("hi").alias("last_id"),
        size.alias("n_ids"),
        F.when(size <= 2, short).otherwise(F.concat_ws("-", "lo", "hi")).alias("text"),
    )
