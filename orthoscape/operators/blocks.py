"""Pairs of rows of a group, compared in pairs of blocks: rows are shuffled once a pair of blocks, pairs never."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import Stage
from .sequential import rank_in_group

BOX = ("x0", "y0", "z0", "x1", "y1", "z1")
BLOCK = 1024
SLABS = 64
#: Tasks for each core, so that none waits for the last.
TASKS_PER_CORE = 16

Compare = Callable[[pa.Table, pa.Table, bool], Iterator[pa.RecordBatch]]


def _by_blocks(keys: list[str], compare: Compare):
    """Calls compare for each pair of blocks; rows come ordered by the keys, then by _side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            left, right = (t.filter(pc.equal(t.column("_side"), s)) for s in (0, 1))
            same = t.column("_lb")[0] == t.column("_rb")[0]
            if left.num_rows and (same or right.num_rows):
                yield from compare(left, left if same else right, same)

        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows - 1, bool)
            for k in keys:
                c = batch.column(batch.schema.get_field_index(k))
                new |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero(new) + 1).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                piece = batch.slice(lo, hi - lo)
                if held and any(held[0].column(k)[0] != piece.column(k)[0] for k in keys):
                    yield from flush()
                    held = []
                held.append(piece)
        if held:
            yield from flush()

    return run


def in_paired_blocks(rows: DataFrame, by: str, key: str, compare: Compare, schema: str, size: int = BLOCK) -> DataFrame:
    """What compare makes of each pair of blocks of each group whose boxes touch.

    rows: by, key, the box (x0, y0, z0, x1, y1, z1) outside of which a row has
    no partner, and what compare needs.  A group's rows are cut into blocks of
    ``size`` along slabs of x and y, and compare gets (left, right, same) for
    each two of them, a block with itself once.  Rows without a box or a group
    have no partner.
    """
    spark = rows.sparkSession
    span = rows.groupBy(by).agg(*[f(c).alias(f"_{n}_{c}") for c in ("x0", "y0") for n, f in (("lo", F.min), ("hi", F.max))])

    def slab(c: str):
        wide = F.col(f"_hi_{c}") - F.col(f"_lo_{c}")
        return F.coalesce(F.least(F.floor(F.try_divide(F.col(c) - F.col(f"_lo_{c}"), wide) * SLABS).try_cast("int"), F.lit(SLABS - 1)), F.lit(0))

    placed = rows.join(span, by).withColumn("_slab", slab("x0") * SLABS + slab("y0")).select(*rows.columns, "_slab")
    ranked = rank_in_group(placed, [by], F.struct("_slab", key), "_at", bucket=F.col("_slab"))
    blocked = Stage(spark, "blocks").write(ranked.select(*rows.columns, F.floor(F.col("_at") / size).cast("int").alias("_block")), "rows")
    boxes = blocked.groupBy(by, "_block").agg(*[(F.min if c[1] == "0" else F.max)(c).alias(c) for c in BOX])
    a, b = (boxes.select(by, F.col("_block").alias(f"_{s}b"), *[F.col(c).alias(f"_{s}{c}") for c in BOX]) for s in "lr")
    touch = F.col("_lb") <= F.col("_rb")
    for c in "xyz":
        touch = touch & (F.col(f"_l{c}0") <= F.col(f"_r{c}1")) & (F.col(f"_r{c}0") <= F.col(f"_l{c}1"))
    end = lambda c, s: F.struct(F.col(c).alias("_block"), F.lit(s).alias("_side"))
    ends = F.explode(F.when(F.col("_lb") == F.col("_rb"), F.array(end("_lb", 0))).otherwise(F.array(end("_lb", 0), end("_rb", 1)))).alias("_end")
    pairs = a.join(b, by).filter(touch).select(by, "_lb", "_rb", ends).select(by, "_lb", "_rb", "_end.*")
    keys = [by, "_lb", "_rb"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    dealt = blocked.join(pairs, [by, "_block"]).drop("_block").repartition(tasks, *keys).sortWithinPartitions(*keys, "_side", key)
    return dealt.mapInArrow(_by_blocks(keys, compare), schema)
