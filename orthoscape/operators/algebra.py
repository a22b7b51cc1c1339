"""Set operations and dataset algebra: concatenation, repetition, epochs of fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rng import shuffle_key


def concatenated(parts: list[tuple[str, DataFrame]], local: str = "local") -> DataFrame:
    """All rows with (dataset, local, index): index is the dataset's offset plus the local index.

    Only one size a dataset reaches the driver.
    """
    out, offset = None, 0
    for name, df in parts:
        tagged = df.withColumn("dataset", F.lit(name)).withColumn("index", F.col(local) + offset)
        offset += df.count()
        out = tagged if out is None else out.unionByName(tagged)
    return out


def locate(queries: DataFrame, sizes: DataFrame, index: str = "index", pieces: int = 4096) -> DataFrame:
    """Which dataset a global index falls into, and the local index there; indices past the end give no row.

    sizes has one row a dataset, any number of them.  All indices are cut into
    ``pieces`` cells; a dataset is entered in the cells that it covers, so both
    sides meet by an equi join.
    """
    total = sizes.agg(F.sum("size")).first()[0] or 0
    cell = max(1, -(-total // pieces))
    w = Window.orderBy("dataset")
    spans = sizes.withColumn("_end", F.sum("size").over(w)).withColumn("_start", F.col("_end") - F.col("size")).filter("size > 0")
    cells = spans.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_start") / cell), F.floor((F.col("_end") - 1) / cell))))
    hit = queries.withColumn("_cell", F.floor(F.col(index) / cell)).join(cells, "_cell").filter((F.col(index) >= F.col("_start")) & (F.col(index) < F.col("_end")))
    return hit.select(*queries.columns, "dataset", (F.col(index) - F.col("_start")).alias("local"))


def repeated(df: DataFrame, times: int, index: str) -> DataFrame:
    """Each row ``times`` times; row k of id i has id i * times + k."""
    return df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(times - 1)))).withColumn("source_index", F.col(index)).withColumn(index, F.col(index) * times + F.col("_k")).drop("_k")


def resized(df: DataFrame, size: int, epoch: int, index: str) -> DataFrame:
    """Exactly ``size`` rows for an epoch: whole permutations one after the other, the last one cut.

    The permutation orders rows by a hash of (epoch + 777, index), so it is
    the same on any cluster.  position counts from 0.
    """
    from .sequential import dense_index

    n = df.count()
    if n == 0:
        return df.withColumn("repetition", F.lit(0)).withColumn("position", F.lit(0).cast("long"))
    ranked = dense_index(df.withColumn("_h", shuffle_key(epoch + 777, F.col(index))), "_h", "_r")
    rounds = -(-size // n)
    out = ranked.withColumn("repetition", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))).withColumn("position", F.col("repetition").cast("long") * n + F.col("_r"))
    return out.filter(F.col("position") < size).drop("_h", "_r")
