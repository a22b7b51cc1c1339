"""Operators along an order: renumbering, islands, resampling, walks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_index(df: DataFrame, order: str, out: str, by: list[str] | None = None, pieces: int = 64) -> DataFrame:
    """0-based dense numbers of a unique column's order, within groups if given.

    Without groups, rows are dealt by range, counted by range, and numbered
    inside ranges, so that no single task has to sort everything.
    """
    if by:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(order)).cast("long") - 1)
    thin = max(1, df.count() // 5000)
    seen = sorted(r[0] for r in df.filter(F.pmod(F.xxhash64(order), F.lit(thin)) == 0).select(order).limit(20_000).collect() if r[0] is not None)
    cuts = list(dict.fromkeys(seen[i * len(seen) // pieces] for i in range(1, pieces))) if seen else []
    piece = sum((F.when(F.col(order) > F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    dealt = df.withColumn("_piece", piece)
    counts = {r[0]: r[1] for r in dealt.groupBy("_piece").count().collect()}  # at most ``pieces`` rows
    base, total = {}, 0
    for p in sorted(counts):
        base[p], total = total, total + counts[p]
    start = F.create_map(*[F.lit(x) for kv in base.items() for x in kv]) if base else None
    if start is None:
        return df.withColumn(out, F.lit(0).cast("long"))
    inside = F.row_number().over(Window.partitionBy("_piece").orderBy(order)) - 1
    return dealt.withColumn(out, (inside + start[F.col("_piece")]).cast("long")).drop("_piece")


def rank_in_group(df: DataFrame, keys: list[str], order: Column, out: str, rows_per_bucket: int = 50_000, bucket: Column | None = None) -> DataFrame:
    """Add ``out``: a dense 0-based rank of each row inside its group.

    The order inside a group is (bucket of ``order``'s hash, order).  A group,
    however hot, is spread over many buckets: buckets are counted, their
    offsets summed, and rows ranked inside (group, bucket) only, so no task
    ever sorts a whole group.  ``order`` must be unique inside a group.  With
    ``bucket``, which must not fall as ``order`` rises, the rank is that of
    ``order`` itself.
    """
    if bucket is None:
        buckets = max(1, -(-df.count() // rows_per_bucket))
        bucket = F.pmod(F.xxhash64("_order"), F.lit(buckets))
    tagged = df.withColumn("_order", order).withColumn("_bucket", bucket)
    sizes = tagged.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_order")
    ranked = tagged.withColumn("_within", F.row_number().over(inside) - 1)
    return ranked.join(offsets, [*keys, "_bucket"]).withColumn(out, (F.col("_base") + F.col("_within")).cast("long")).drop("_order", "_bucket", "_base", "_within")


def islands(df: DataFrame, position: str, by: list[str], cap: int, out: str = "island") -> DataFrame:
    """Runs of consecutive positions, cut after every ``cap`` rows; numbered from 0 in each group."""
    w = Window.partitionBy(*by).orderBy(position)
    jump = F.coalesce((F.col(position) - F.lag(position).over(w) > 1).cast("int"), F.lit(0))
    runs = df.withColumn("_run", F.sum(jump).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.row_number().over(Window.partitionBy(*by, "_run").orderBy(position)) - 1
    cut = runs.withColumn("_part", F.floor(place / F.lit(cap)))
    return cut.withColumn(out, (F.dense_rank().over(Window.partitionBy(*by).orderBy("_run", "_part")) - 1).cast("long")).drop("_run", "_part")


def greedy_prune(df: DataFrame, by: list[str], order: str, position: list[str], angle: str, min_distance: float, min_angle: float) -> DataFrame:
    """(by, order) of the rows that are farther than a distance or an angle from the last kept row of their group.

    The choice depends on the last kept row only, so groups are read as an
    ordered Arrow stream that holds that row: one shuffle, and memory of one
    batch however long a group is.  A null or NaN position or angle is never
    farther; a group's first row is always kept.
    """
    keys = [F.col(b) for b in by]
    slim = df.select(*keys, F.col(order), *[F.col(c).cast("double").alias(f"_p{i}") for i, c in enumerate([*position, angle])])
    kinds = dict(slim.dtypes)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last = None, None
        for batch in batches:
            of = list(zip(*(batch.column(i).to_pylist() for i in range(len(by))), strict=True)) if by else [()] * batch.num_rows
            at = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(len(by) + 1, batch.num_columns)])
            keep = np.zeros(batch.num_rows, bool)
            for i, (g, p) in enumerate(zip(of, at, strict=True)):
                if g == group:
                    turn = abs(p[-1] - last[-1]) % 360
                    if not (np.sqrt(((p[:-1] - last[:-1]) ** 2).sum()) > min_distance or min(turn, 360 - turn) > min_angle):
                        continue
                group, last, keep[i] = g, p, True
            yield batch.select(list(range(len(by) + 1))).filter(pa.array(keep))

    dealt = slim.repartition(*keys) if by else slim.coalesce(1)
    return dealt.sortWithinPartitions(*keys, F.col(order)).mapInArrow(fold, ", ".join(f"`{c}` {kinds[c]}" for c in [*by, order]))


def boustrophedon(df: DataFrame, by: list[str], lane: str, along: str, out: str = "step") -> DataFrame:
    """Snake order: odd lanes run backwards; numbered from 0 in each group."""
    signed = F.when(F.col(lane) % 2 == 0, F.col(along)).otherwise(-F.col(along))
    return df.withColumn(out, (F.row_number().over(Window.partitionBy(*by).orderBy(F.col(lane), signed)) - 1).cast("long"))


def ping_pong(n: Column, k: Column) -> Column:
    """k indices 0, 1, .., n-1, n-2, .., 1, 0, 1, .. over n elements; n of 1 repeats 0."""
    period = F.greatest(F.lit(1), 2 * n - 2)
    return F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.when(i % period < n, i % period).otherwise(period - i % period).cast("int"))


def resample_index(k: Column, wanted: int, have: Column) -> Column:
    """The index of the k-th of ``wanted`` evenly spaced elements of ``have``, halves to even."""
    return F.bround(k * (have - 1) / F.lit(max(1, wanted - 1))).cast("long")
