"""Aggregations over frames, scenes, rasters and meters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def field_of_view(width: Column, focal: Column) -> Column:
    return F.degrees(2 * F.atan(width / (2 * focal)))


def mode_first_seen(df: DataFrame, by: list[str], values: list[str], order: str) -> DataFrame:
    """The most frequent combination of values in each group; ties to the one seen first."""
    counted = df.groupBy(*by, *values).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    best = counted.groupBy(*by).agg(F.max_by(F.struct(*values), F.struct("_n", -F.col("_first"))).alias("_m"))
    return best.select(*by, *[F.col(f"_m.{v}").alias(v) for v in values])


def masked_mean(x: Column, mask: Column) -> Column:
    """Mean of finite x where mask holds; null without any."""
    ok = mask & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.avg(F.when(ok, x))


def robust_tolerance(df: DataFrame, by: list[str], x: str, k: float) -> DataFrame:
    """Median, median absolute deviation, and median + k * deviation of each group."""
    mid = df.groupBy(*by).agg(F.median(x).alias("med"))
    off = df.join(mid, by).groupBy(*by).agg(F.first("med").alias("med"), F.median(F.abs(F.col(x) - F.col("med"))).alias("mad"))
    return off.withColumn("tolerance", F.col("med") + k * F.col("mad"))


def normalised_by_nonzero_mean(df: DataFrame, by: list[str], x: str, out: str) -> DataFrame:
    """x over the mean of its valid values (> 0) in its group, with the factor floored at 1e-8."""
    factor = df.groupBy(*by).agg(F.greatest(F.sum(F.when(F.col(x) > 0, F.col(x)).otherwise(0.0)) / (F.count_if(F.col(x) > 0) + 1e-8), F.lit(1e-8)).alias("factor"))
    return df.join(factor, by).withColumn(out, F.col(x) / F.col("factor"))


def principal_axis(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Unit eigenvector (ax, ay) of the larger eigenvalue of the 2x2 covariance (n - 1), pointing to x > 0 (or y >= 0)."""
    m = df.groupBy(*by).agg(F.var_samp(x).alias("_a"), F.covar_samp(x, y).alias("_b"), F.var_samp(y).alias("_c"))
    top = (F.col("_a") + F.col("_c")) / 2 + F.sqrt(((F.col("_a") - F.col("_c")) / 2) * ((F.col("_a") - F.col("_c")) / 2) + F.col("_b") * F.col("_b"))
    ux = F.when(F.abs("_b") > 1e-15, F.col("_b")).when(F.col("_a") >= F.col("_c"), 1.0).otherwise(0.0)
    uy = F.when(F.abs("_b") > 1e-15, top - F.col("_a")).when(F.col("_a") >= F.col("_c"), 0.0).otherwise(1.0)
    n = F.sqrt(ux * ux + uy * uy)
    sign = F.when((ux < 0) | ((ux == 0) & (uy < 0)), -1.0).otherwise(1.0)
    return m.select(*by, (sign * ux / n).alias("ax"), (sign * uy / n).alias("ay"), top.alias("variance"))


def auc_of_errors(df: DataFrame, by: list[str], error: str, limit: int) -> DataFrame:
    """Mean over thresholds 1..limit of the share of errors below each; the last bin is closed.

    An error's weight is the number of thresholds it stays under, so one
    aggregate is enough; errors out of range or null count in the total only.
    """
    e = F.col(error)
    bin_ = F.least(F.floor(e), F.lit(limit - 1))
    weight = F.when((e >= 0) & (e <= limit), limit - bin_).otherwise(0)
    return df.groupBy(*by).agg((F.sum(weight) / F.count(F.lit(1)) / limit).alias("auc"))


def inlier_ratio(gt: Column, pred: Column, threshold: float) -> Column:
    """Share of valid gt (> 0) with max(gt/pred, pred/gt) under the threshold; pred of 0 is an outlier; null without any."""
    up, down = F.try_divide(gt, pred), F.try_divide(pred, gt)
    rel = F.greatest(F.coalesce(up, F.lit(threshold + 1.0)), F.coalesce(down, F.lit(0.0)))
    return F.try_divide(F.count_if((gt > 0) & (rel > 0) & (rel < threshold)).cast("double"), F.count_if(gt > 0))


def mean_relative_error(gt: Column, pred: Column) -> Column:
    return F.avg(F.when(gt > 0, F.abs(gt - pred) / gt))


def rig_groups(frames: DataFrame, by: list[str], time: str, camera: str) -> DataFrame:
    """frame_id (0-based rank of the time) and cam_id (cam001.. by camera order) of each row, by scene.

    Ranks come from the distinct times and cameras, which are small tables,
    not from a sort of all rows.
    """
    w = Window.partitionBy(*by)
    times = frames.select(*by, time).distinct().withColumn("frame_id", F.row_number().over(w.orderBy(time)).cast("long") - 1)
    cams = frames.select(*by, camera).distinct().withColumn("cam_id", F.format_string("cam%03d", F.row_number().over(w.orderBy(camera))))
    return frames.join(times, [*by, time]).join(cams, [*by, camera])


def polygon(df: DataFrame, by: list[str], order: str, x: str, y: str) -> DataFrame:
    """Area and centroid of each group's closed polygon, by the shoelace formula."""
    w = Window.partitionBy(*by).orderBy(order)
    ring = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nx, ny = (F.coalesce(F.lead(c).over(w), F.first(c).over(ring)) for c in (x, y))
    e = df.withColumn("_nx", nx).withColumn("_ny", ny).withColumn("_k", F.col(x) * F.col("_ny") - F.col("_nx") * F.col(y))
    s = e.groupBy(*by).agg(F.sum("_k").alias("_a"), F.sum((F.col(x) + F.col("_nx")) * F.col("_k")).alias("_x"), F.sum((F.col(y) + F.col("_ny")) * F.col("_k")).alias("_y"))
    return s.select(*by, F.abs(F.col("_a") / 2).alias("area"), F.try_divide(F.col("_x"), 3 * F.col("_a")).alias("cx"), F.try_divide(F.col("_y"), 3 * F.col("_a")).alias("cy"))


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull of 2-D points, counter-clockwise, without collinear points."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p

    def half(order):
        out: list = []
        for q in order:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 1e-12:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(half(p) + half(p[::-1]))


def convex_hulls(df: DataFrame, by: str, x: str, y: str, cells: int = 16) -> DataFrame:
    """(by, i, x, y): each group's hull vertices.

    Hulls are taken of slices of a group first, as the hull of a set is the
    hull of its slices' hulls; so a large group is spread over tasks.
    """
    schema = f"{by} long, x double, y double"

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        h = hull(pdf[["x", "y"]].to_numpy())
        return pd.DataFrame({by: pdf[by].iloc[0], "x": h[:, 0], "y": h[:, 1]})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        h = hull(pdf[["x", "y"]].to_numpy())
        return pd.DataFrame({by: pdf[by].iloc[0], "i": range(len(h)), "x": h[:, 0], "y": h[:, 1]})

    slim = df.select(F.col(by).cast("long").alias(by), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    sliced = slim.withColumn("_s", F.pmod(F.xxhash64("x", "y"), F.lit(cells)))
    return sliced.groupBy(by, "_s").applyInPandas(part, schema).groupBy(by).applyInPandas(whole, f"{by} long, i int, x double, y double")


def moments(df: DataFrame, by: list[str], a: tuple[str, str, str], b: tuple[str, str, str]) -> DataFrame:
    """Means of two paired point sets and their 3x3 cross-covariances and variances, in one aggregate."""
    aggs = [F.avg(c).alias(f"ma{i}") for i, c in enumerate(a)] + [F.avg(c).alias(f"mb{i}") for i, c in enumerate(b)]
    aggs += [F.covar_pop(x, y).alias(f"c{i}{j}") for i, x in enumerate(a) for j, y in enumerate(b)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *aggs)


def trajectory_error(df: DataFrame, by: str, gt: tuple[str, str, str], pred: tuple[str, str, str]) -> DataFrame:
    """Mean distance of gt to pred after the best rigid alignment (rotation and shift) of each group.

    Only the moments of a group, 16 numbers, reach Python for the SVD.
    """

    def rotation(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                h = np.array([[getattr(r, f"c{i}{j}") for j in range(3)] for i in range(3)])
                u, _, vt = np.linalg.svd(h)
                d = np.sign(np.linalg.det(vt.T @ u.T)) or 1.0
                rot = vt.T @ np.diag([1, 1, d]) @ u.T
                shift = np.array([r.mb0, r.mb1, r.mb2]) - rot @ np.array([r.ma0, r.ma1, r.ma2])
                rows.append((getattr(r, by), [*rot.ravel(), *shift]))
            yield pd.DataFrame(rows, columns=[by, "t"])

    t = moments(df, [by], pred, gt).mapInPandas(rotation, f"{by} {dict(df.dtypes)[by]}, t array<double>")
    j = df.join(t, by)
    moved = [sum((F.get("t", 3 * i + k) * F.col(pred[k]) for k in range(3)), F.get("t", 9 + i)) for i in range(3)]
    d2 = sum(((moved[i] - F.col(gt[i])) * (moved[i] - F.col(gt[i])) for i in range(3)), F.lit(0.0))
    return j.groupBy(by).agg(F.avg(F.sqrt(d2)).alias("ate"))
