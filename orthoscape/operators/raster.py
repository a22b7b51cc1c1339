"""Rasters as rows (keys.., y, x, value): windows, edges, normals, warps, components.

Neighbourhoods are two one-dimensional window passes (rows, then columns),
which sort an image twice but copy no pixel, or offset joins where the window
isn't separable.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unproject(x: Column, y: Column, z: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column, Column]:
    return (x - cx) * z / fx, (y - cy) * z / fy, z


def ray(x: Column, y: Column, fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column, Column]:
    """Unit direction of a pixel; the range is depth over its last component."""
    a, b = (x - cx) / fx, (y - cy) / fy
    n = F.sqrt(a * a + b * b + 1)
    return a / n, b / n, 1 / n


def nearest_pixel(p: Column, size: Column | int) -> Column:
    """The pixel that a coordinate rounds to (halves to even), clamped into the image."""
    return F.greatest(F.lit(0), F.least(F.bround(p).cast("int"), F.lit(size) - 1 if isinstance(size, int) else size - 1))


def window_2d(df: DataFrame, keys: list[str], value: str, radius: int, f, out: str, y: str = "y", x: str = "x") -> DataFrame:
    """A separable window aggregate (max, min, sum) of (2 radius + 1) squared; outside and null count for nothing."""
    rows = Window.partitionBy(*keys, y).orderBy(x).rangeBetween(-radius, radius)
    cols = Window.partitionBy(*keys, x).orderBy(y).rangeBetween(-radius, radius)
    return df.withColumn("_r", f(value).over(rows)).withColumn(out, f("_r").over(cols)).drop("_r")


def sliding(df: DataFrame, keys: list[str], order: str, value: str, width: int, stride: int, out: str = "w") -> DataFrame:
    """Windows of width elements: (n - width + 1) // stride of them, numbered from 0, as arrays."""
    w = Window.partitionBy(*keys).orderBy(order)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    at = F.row_number().over(w) - 1
    held = df.select(*keys, at.alias("_i"), size.alias("_n"), F.collect_list(value).over(w.rowsBetween(0, width - 1)).alias(out))
    count = F.floor((F.col("_n") - width + 1) / stride)
    return held.filter((F.col("_i") % stride == 0) & (F.floor(F.col("_i") / stride) < count)).select(*keys, F.floor(F.col("_i") / stride).cast("long").alias("k"), out)


def depth_edges(df: DataFrame, keys: list[str], z: str, atol: float | None, rtol: float | None) -> DataFrame:
    """edge: the 3x3 range of valid depths exceeds atol, or rtol times the depth."""
    valid = df.withColumn("_v", F.when(F.col(z) > 0, F.col(z)))
    both = window_2d(window_2d(valid, keys, "_v", 1, F.max, "_hi"), keys, "_v", 1, F.min, "_lo")
    span = F.col("_hi") - F.col("_lo")
    edge = F.lit(False)
    if atol is not None:
        edge = edge | F.coalesce(span > atol, F.lit(False))
    if rtol is not None:
        edge = edge | F.coalesce(F.try_divide(span, F.col("_v")) > rtol, F.lit(False))
    return both.withColumn("edge", edge).drop("_v", "_hi", "_lo")


def depth_aliasing(df: DataFrame, keys: list[str], z: str, tolerance: float) -> DataFrame:
    """alias: the nearer of the 3x3 extremes is farther than the tolerance."""
    both = window_2d(window_2d(df, keys, z, 1, F.max, "_hi"), keys, z, 1, F.min, "_lo")
    return both.withColumn("alias", F.least(F.col("_hi") - F.col(z), F.col(z) - F.col("_lo")) > tolerance).drop("_hi", "_lo")


def dilate(df: DataFrame, keys: list[str], mask: str, radius: int, times: int = 1) -> DataFrame:
    """A 0/1 mask grown by a square, ``times`` over; one pass of the summed radius is the same."""
    return window_2d(df, keys, mask, radius * times, F.max, mask)


def shifted(df: DataFrame, keys: list[str], values: list[str], dy: int, dx: int, suffix: str) -> DataFrame:
    """The values of the neighbour at (dy, dx), null outside, by lag and lead along one axis."""
    if dy and dx:
        raise ValueError("one axis at a time")
    w = Window.partitionBy(*keys, "y").orderBy("x") if dx else Window.partitionBy(*keys, "x").orderBy("y")
    return df.withColumns({f"{v}{suffix}": F.lead(v, dx + dy).over(w) if dx + dy > 0 else F.lag(v, -dx - dy).over(w) for v in values})


def normals(points: DataFrame, keys: list[str]) -> DataFrame:
    """Unit normals (nx, ny, nz) of px, py, pz: the mean of the cross products of valid neighbour pairs, in turn.

    Points are null where invalid; a pixel without a valid pair has null.
    """
    p = ["px", "py", "pz"]
    d = points
    for name, (dy, dx) in {"_u": (-1, 0), "_l": (0, -1), "_d": (1, 0), "_r": (0, 1)}.items():
        d = shifted(d, keys, p, dy, dx, name)

    def side(s: str):
        return [F.col(f"{c}{s}") - F.col(c) for c in p]

    sums, parts = [F.lit(0.0)] * 3, []
    for a, b in (("_u", "_l"), ("_l", "_d"), ("_d", "_r"), ("_r", "_u")):
        u, v = side(a), side(b)
        parts.append((u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]))
    for part in parts:
        n = F.sqrt(part[0] * part[0] + part[1] * part[1] + part[2] * part[2])
        sums = [s + F.coalesce(F.try_divide(c, n), F.lit(0.0)) for s, c in zip(sums, part, strict=True)]
    n = F.sqrt(sums[0] * sums[0] + sums[1] * sums[1] + sums[2] * sums[2])
    return d.select(*keys, "y", "x", *[F.when(n > 1e-12, s / n).alias(c) for s, c in zip(sums, ("nx", "ny", "nz"), strict=True)])


def sobel(df: DataFrame, keys: list[str], z: str, height: int, width: int) -> DataFrame:
    """3x3 gradient magnitude with mirrored borders (the edge pixel isn't repeated).

    Rows are smoothed and differenced along x first, then combined along y:
    two window passes.
    """

    def around(df: DataFrame, axis: str, other: str, size: int, cols: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys, other).orderBy(axis)
        out = {}
        for c in cols:
            before, after = F.lag(c).over(w), F.lead(c).over(w)
            out[f"{c}_b"] = F.coalesce(before, after)
            out[f"{c}_a"] = F.coalesce(after, before)
        return df.withColumns(out)

    h = around(df, "x", "y", width, [z])
    h = h.withColumn("_s", F.col(f"{z}_b") + 2 * F.col(z) + F.col(f"{z}_a")).withColumn("_d", F.col(f"{z}_a") - F.col(f"{z}_b"))
    v = around(h, "y", "x", height, ["_s", "_d"])
    gx, gy = F.col("_d_b") + 2 * F.col("_d") + F.col("_d_a"), F.col("_s_a") - F.col("_s_b")
    return v.select(*keys, "y", "x", z, F.sqrt(gx * gx + gy * gy).alias("gradient"))


def components(df: DataFrame, key: str, mask: str, least: int) -> DataFrame:
    """(key, y, x, component, kept): 8-connected components of a mask, numbered by their first pixel.

    One image is one group, and its pixels are all that a task holds.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        on = pdf[pdf[mask] > 0].sort_values(["y", "x"])
        at = {(int(y), int(x)): i for i, (y, x) in enumerate(zip(on["y"], on["x"], strict=True))}
        name = np.full(len(on), -1)
        for (y, x), i in at.items():
            if name[i] >= 0:
                continue
            name[i], stack = i, [(y, x)]
            while stack:
                a, b = stack.pop()
                for dy in (-1, 0, 1):
                    for dx in (-1, 0, 1):
                        j = at.get((a + dy, b + dx))
                        if j is not None and name[j] < 0:
                            name[j] = i
                            stack.append((a + dy, b + dx))
        first = on["y"].to_numpy() * 100_000 + on["x"].to_numpy()
        area = np.bincount(name, minlength=len(on)) if len(on) else np.zeros(0, int)
        return pd.DataFrame({key: on[key].to_numpy(), "y": on["y"].to_numpy(), "x": on["x"].to_numpy(), "component": first[name] if len(on) else first, "kept": area[name] >= least if len(on) else np.zeros(0, bool)})

    kinds = dict(df.dtypes)
    return df.select(key, "y", "x", mask).groupBy(key).applyInPandas(run, f"{key} {kinds[key]}, y int, x int, component long, kept boolean")


def area_mean(df: DataFrame, keys: list[str], z: str, by: int) -> DataFrame:
    """Means of valid pixels over by x by cells; 0 where a cell has none."""
    cell = [F.floor(F.col(c) / by).cast("int").alias(c) for c in ("y", "x")]
    ok = F.when(F.col(z) > 0, F.col(z))
    return df.select(*keys, *cell, ok.alias("_v")).groupBy(*keys, "y", "x").agg(F.coalesce(F.avg("_v"), F.lit(0.0)).alias(z))


def brown_distortion(x: Column, y: Column, k: tuple[float, float, float], p: tuple[float, float]) -> tuple[Column, Column]:
    """Radial (three terms) and tangential distortion of normalised coordinates."""
    r2 = x * x + y * y
    radial = 1 + r2 * (k[0] + r2 * (k[1] + r2 * k[2]))
    return x * radial + 2 * p[0] * x * y + p[1] * (r2 + 2 * x * x), y * radial + p[0] * (r2 + 2 * y * y) + 2 * p[1] * x * y


def division_distortion(x: Column, y: Column, k: float) -> tuple[Column, Column]:
    r2 = x * x + y * y
    return x / (1 + k * r2), y / (1 + k * r2)


def fisheye_radius(r: Column, model: str) -> Column:
    """The image radius of a pinhole radius under equidistant, stereographic, equisolid or orthographic projection."""
    t = F.atan(r)
    return {"equidistant": t, "stereographic": 2 * F.tan(t / 2), "equisolid": 2 * F.sin(t / 2), "orthographic": F.sin(t)}[model]


def bilinear(image: DataFrame, queries: DataFrame, keys: list[str], value: str, u: str = "u", v: str = "v") -> DataFrame:
    """queries with the bilinear value at (u, v) = (x, y); pixels outside count as 0. One equi join on the four corners."""
    x0, y0 = F.floor(u), F.floor(v)
    fx, fy = F.col(u) - x0, F.col(v) - y0
    corners = F.array(*[F.struct((y0 + dy).cast("int").alias("y"), (x0 + dx).cast("int").alias("x"), ((fy if dy else 1 - fy) * (fx if dx else 1 - fx)).alias("wt")) for dy in (0, 1) for dx in (0, 1)])
    own = [c for c in queries.columns]
    spread = queries.withColumn("_c", F.explode(corners)).select(*own, F.col("_c.y").alias("y_"), F.col("_c.x").alias("x_"), F.col("_c.wt").alias("_w"))
    pixel = image.select(*keys, F.col("y").alias("y_"), F.col("x").alias("x_"), F.col(value).alias("_p"))
    return spread.join(pixel, [*keys, "y_", "x_"], "left").groupBy(*own).agg(F.sum(F.col("_w") * F.coalesce("_p", F.lit(0.0))).alias(value))


def vignette(r: Column, r_max: Column, strength: float) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - strength * (r / r_max) * (r / r_max)))


def rectified(df: DataFrame, key: str, k: tuple[float, float, float], p: tuple[float, float] = (0.0, 0.0), rounds: int = 100, tolerance: float = 1e-9) -> DataFrame:
    """ux, uy: undistorted normalised coordinates of x, y by fixed-point inversion, in Arrow batches.

    Radial and tangential terms are those of ``brown_distortion``.  A point
    that doesn't settle in ``rounds`` steps is null.
    """

    @F.pandas_udf("struct<ux double, uy double>")
    def solve(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        a, b = x.to_numpy(float), y.to_numpy(float)
        ux, uy, gap = a.copy(), b.copy(), np.full(len(a), np.inf)
        for _ in range(rounds):
            r2 = ux * ux + uy * uy
            radial = 1 + r2 * (k[0] + r2 * (k[1] + r2 * k[2]))
            nx = (a - 2 * p[0] * ux * uy - p[1] * (r2 + 2 * ux * ux)) / radial
            ny = (b - p[0] * (r2 + 2 * uy * uy) - 2 * p[1] * ux * uy) / radial
            gap = np.maximum(np.abs(nx - ux), np.abs(ny - uy))
            ux, uy = nx, ny
            if not (gap >= tolerance).any():
                break
        lost = ~(gap < tolerance)
        ux[lost], uy[lost] = np.nan, np.nan
        return pd.DataFrame({"ux": pd.Series(ux).where(~lost, None), "uy": pd.Series(uy).where(~lost, None)})

    return df.withColumn("_u", solve("x", "y")).select(*df.columns, "_u.ux", "_u.uy")


def rectified_image(image: DataFrame, key: str, value: str, fx: float, fy: float, cx: float, cy: float, k: tuple[float, float, float], p: tuple[float, float], height: int, width: int) -> DataFrame:
    """(key, y, x, value, valid): the image without its lens distortion, on the grid of its own pixels.

    A pixel of the result looks up, bilinearly, the place that distortion
    moves it to; no inversion is needed in that direction.  Places outside the
    image aren't valid and are null.
    """
    u, v = (F.col("x") - cx) / fx, (F.col("y") - cy) / fy
    du, dv = brown_distortion(u, v, k, p)
    at = image.select(key, F.col("y").alias("_j"), F.col("x").alias("_i"), (du * fx + cx).alias("u"), (dv * fy + cy).alias("v"))
    inside = (F.col("u") >= 0) & (F.col("v") >= 0) & (F.col("u") <= width - 1) & (F.col("v") <= height - 1)
    out = bilinear(image, at, [key], value)
    return out.select(key, F.col("_j").alias("y"), F.col("_i").alias("x"), F.when(inside, F.col(value)).alias(value), inside.alias("valid"))


def fuse(a: Column, b: Column) -> Column:
    """a where valid, else b where valid, else 0."""
    ok = lambda z: F.coalesce((z > 0) & ~F.isnan(z) & (z != float("inf")), F.lit(False))
    return F.when(ok(a), a).when(ok(b), b).otherwise(F.lit(0.0))


def stacked(df: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """(by, items, lengths, stack): a group's arrays in order, as they are (ragged) and as one array padded with nulls.

    Arrays of equal length need no padding; a group is one row, so it is meant
    for batches, not for whole tables.
    """
    held = df.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))).alias("_l"))
    items = held.select(*by, F.transform("_l", lambda x: x["v"]).alias("items")).withColumn("lengths", F.transform("items", F.size))
    longest = F.array_max("lengths")
    kind = df.schema[value].dataType.elementType
    pad = F.transform("items", lambda v: F.concat(v, F.array_repeat(F.lit(None).cast(kind), longest - F.size(v))))
    return items.withColumn("stack", pad)
