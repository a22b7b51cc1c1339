"""Staged tables in the shared folder, and skew-safe building blocks.

Lineage is cut with Parquet tables under ``spark.checkpoint.dir``, which every
executor sees, so a lost executor costs a recomputation of its own tasks only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequential import rank_in_group
from ..sources.shared import Stage

__all__ = ["KeyFilter", "Stage", "attach_by_key", "key_filter", "partitions", "rank_in_group", "without_rows"]

def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def attach_by_key(left: DataFrame, right: DataFrame, key: list[str], total: int, size: str, share: int = 1000) -> DataFrame:
    """Left join on a key that may be very hot; right has one row a key.

    ``size`` is right's column with the rows of its key in left, and ``total``
    the rows of left.  A key with over total/share rows is hot; there are fewer
    than ``share`` of these whatever the data, so their rows of right are
    broadcast.  All other keys are joined by a shuffle in which no key exceeds
    total/share rows.
    """
    limit = max(256, total // share)
    hot = F.broadcast(right.filter(F.col(size) > limit))
    rest = right.filter(F.col(size) <= limit)
    marked = left.join(F.broadcast(right.filter(F.col(size) > limit).select(*key, F.lit(True).alias("_hot"))), key, "left")
    cold = marked.filter(F.col("_hot").isNull()).drop("_hot").join(rest, key, "left")
    warm = marked.filter(F.col("_hot")).drop("_hot").join(hot, key)
    return cold.unionByName(warm)


class KeyFilter:
    """A broadcast table of bits: false for most 64-bit hashes that aren't among the keys, true for all that are."""

    def __init__(self, shared, bits: int):
        self.shared, self.shift = shared, 64 - (bits.bit_length() - 1)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.view(np.uint64) >> np.uint64(self.shift)
        return (self.shared.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0

    def column(self, hashes: Column) -> Column:
        test = F.arrow_udf(lambda x: pa.array(self.may_hold(x.to_numpy(zero_copy_only=False))), "boolean")
        return test(hashes)


def key_filter(keys: DataFrame, key: str, most_bits: int = 1 << 26) -> KeyFilter:
    """A filter of a column of distinct well-mixed hashes, so that rows without a partner stay out of a join's shuffle.

    It has about 16 bits a key and ``most_bits`` (8 MB) at most, and is filled
    on the cluster.  With more keys more rows pass, and the join decides.
    """
    spark = keys.sparkSession
    bits = min(most_bits, max(1 << 12, 1 << int(16 * keys.count()).bit_length()))
    place = F.shiftrightunsigned(F.col(key), 64 - (bits.bit_length() - 1))
    filled = keys.select(place.alias("_p")).select(F.shiftright("_p", 6).alias("word"), F.expr("shiftleft(1L, cast(_p & 63 as int))").alias("bit"))
    found = filled.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most most_bits / 64 rows
    table = np.zeros(bits // 64, np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return KeyFilter(spark.sparkContext.broadcast(table), bits)


def without_rows(docs: DataFrame, gone: DataFrame, row: str) -> DataFrame:
    """Rows of docs whose unique number isn't in gone: an anti join into which only rows go that the filter can't clear."""
    may_go = key_filter(gone.select(F.xxhash64(row).alias("h")), "h")
    marked = docs.withColumn("_may_go", may_go.column(F.xxhash64(row)))
    kept = marked.filter("not _may_go").drop("_may_go")
    return kept.unionByName(marked.filter("_may_go").drop("_may_go").join(gone.select(row), row, "left_anti"))
