"""Cleaning of depth rasters: threshold, edges, dilation, small components, with the statistics of each step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import raster as ras


def filter_depth(pixels: DataFrame, key: str, offset: float = 1.0, percentile: float = 0.98, radius: int = 1, times: int = 1, least_area: int = 4, height: int = 8, width: int = 8) -> tuple[DataFrame, DataFrame]:
    """(cleaned pixels, statistics by file) of rasters (key, y, x, z).

    Values up to the smallest valid depth plus ``offset`` are removed (zeros
    count as removed, too); pixels over the percentile of the gradient of all
    finite pixels are edges, their dilation is invalidated, and 8-connected
    components of fewer than ``least_area`` valid pixels go.
    """
    low = pixels.groupBy(key).agg((F.min(F.when(F.col("z") > 1e-6, F.col("z"))) + offset).alias("_thr"))
    cut = pixels.join(low, key).withColumn("_drop", F.coalesce(F.col("z") <= F.col("_thr"), F.lit(False)))
    thresholded = cut.select(key, "y", "x", F.when(F.col("_drop") | (F.col("z") <= 0), 0.0).otherwise(F.col("z")).alias("z"), "_drop", (F.col("z") > 0).alias("_before"))
    grad = ras.sobel(thresholded.select(key, "y", "x", "z"), [key], "z", height, width)
    limit = grad.groupBy(key).agg(F.percentile("gradient", percentile).alias("_g"))
    edges = grad.join(limit, key).select(key, "y", "x", (F.col("gradient") > F.col("_g")).cast("int").alias("edge"))
    band = ras.dilate(edges.withColumn("band", F.col("edge")), [key], "band", radius, times)
    kept = thresholded.join(band, [key, "y", "x"]).withColumn("z", F.when(F.col("band") > 0, 0.0).otherwise(F.col("z")))
    parts = ras.components(kept.withColumn("_m", (F.col("z") > 0).cast("int")), key, "_m", least_area).select(key, "y", "x", "kept")
    done = kept.join(parts, [key, "y", "x"], "left").withColumn("z", F.when(F.coalesce("kept", F.lit(False)), F.col("z")).otherwise(0.0))
    stats = done.groupBy(key).agg(F.count(F.lit(1)).alias("total_pixels"), F.count_if("_before").alias("valid_before"), F.count_if("_drop").alias("threshold_removed"), F.sum("edge").alias("edge_pixels"), F.sum("band").alias("band_pixels"), F.count_if(F.col("z") > 0).alias("valid_after"))
    return done.select(key, "y", "x", "z"), stats
