"""Flight planning: spacing, lawnmower routes, rigs, splits, densification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The five cameras of a rig and their yaw (nadir, forward, right, back, left).
RIG = (("N", 0), ("F", 0), ("R", 90), ("B", 180), ("L", 270))


def swath(height: Column, fov: Column) -> Column:
    return 2 * height * F.tan(F.radians(fov) / 2)


def spacing(height: Column, fov: Column, overlap: float) -> Column:
    return F.greatest(F.lit(0.2), swath(height, fov) * (1 - overlap))


def waypoint_estimate(area: Column, cell: Column, efficiency: float) -> Column:
    return F.greatest(F.lit(1), F.ceil(area / (cell * efficiency))).cast("long")


def region(df: DataFrame, by: list[str], x: str, y: str, margin: float) -> DataFrame:
    """Bounding box of each group, grown by a share of its extents on each side."""
    box = df.groupBy(*by).agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    dx, dy = (F.col("x1") - F.col("x0")) * margin, (F.col("y1") - F.col("y0")) * margin
    return box.select(*by, (F.col("x0") - dx).alias("x0"), (F.col("x1") + dx).alias("x1"), (F.col("y0") - dy).alias("y0"), (F.col("y1") + dy).alias("y1"))


def lawnmower(polygons: DataFrame, by: str, lane: float, point: float) -> DataFrame:
    """(by, lane_no, seg, k, px, py) along lanes of polygons (by, i, x, y), in snake order.

    Lanes run along the longer side (x on ties).  A lane crosses an edge if
    ymin - 1e-12 <= y < ymax - 1e-12; sorted crossings, made distinct to 1e-9,
    pair up to segments (an odd last one is dropped), and those shorter than
    0.35 points are dropped.  Odd lanes are flown backwards, segments and
    points.  An edge is joined to the lanes in its own span only.
    """
    w = Window.partitionBy(by).orderBy("i")
    all_ = Window.partitionBy(by)
    wide = (F.max("x").over(all_) - F.min("x").over(all_)) >= (F.max("y").over(all_) - F.min("y").over(all_))
    turned = polygons.select(by, "i", wide.alias("wide"), F.when(wide, F.col("x")).otherwise(F.col("y")).alias("u"), F.when(wide, F.col("y")).otherwise(F.col("x")).alias("v"))
    ring = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = turned.withColumn("u2", F.coalesce(F.lead("u").over(w), F.first("u").over(ring))).withColumn("v2", F.coalesce(F.lead("v").over(w), F.first("v").over(ring))).withColumn("base", F.min("v").over(all_))
    lo, hi = F.least("v", "v2"), F.greatest("v", "v2")
    first, last = F.greatest(F.lit(0), F.ceil((lo - F.col("base") - 1e-12) / lane)).cast("int"), F.floor((hi - F.col("base") + 1e-9) / lane).cast("int")
    lanes = edge.filter(first <= last).withColumn("lane_no", F.explode(F.sequence(first, last))).withColumn("at", F.col("base") + F.col("lane_no") * lane)
    hit = lanes.filter((F.col("at") >= lo - 1e-12) & (F.col("at") < hi - 1e-12) & (F.col("v") != F.col("v2")))
    cut = hit.select(by, "wide", "lane_no", "at", F.round(F.col("u") + (F.col("at") - F.col("v")) / (F.col("v2") - F.col("v")) * (F.col("u2") - F.col("u")), 9).alias("u")).distinct()
    order = Window.partitionBy(by, "lane_no").orderBy("u")
    placed = cut.withColumn("n", F.row_number().over(order) - 1).withColumn("end", F.lead("u").over(order))
    seg = placed.filter((F.col("n") % 2 == 0) & F.col("end").isNotNull() & (F.col("end") - F.col("u") >= max(1e-6, 0.35 * point))).withColumn("seg", F.floor(F.col("n") / 2).cast("int"))
    steps = F.floor((F.col("end") - F.col("u") + 1e-9) / point).cast("int")
    odd = F.col("lane_no") % 2 == 1
    points = seg.withColumn("k", F.explode(F.sequence(F.lit(0), steps))).withColumn("along", F.when(odd, F.col("end") - F.col("k") * point).otherwise(F.col("u") + F.col("k") * point))
    px, py = F.when(F.col("wide"), F.col("along")).otherwise(F.col("at")), F.when(F.col("wide"), F.col("at")).otherwise(F.col("along"))
    return points.select(by, "lane_no", "seg", "k", px.alias("px"), py.alias("py"))


def rig_views(waypoints: DataFrame) -> DataFrame:
    """Each waypoint with each camera of the rig; the rig is a literal array, exploded in place."""
    rig = F.array(*[F.struct(F.lit(n).alias("cam"), F.lit(float(y)).alias("yaw")) for n, y in RIG])
    return waypoints.withColumn("_r", F.explode(rig)).select(*waypoints.columns, "_r.cam", "_r.yaw")


def two_way_split(df: DataFrame, by: list[str], x: str, y: str, order: str) -> DataFrame:
    """half: 1 where the projection on the principal axis exceeds the group's median, else 0."""
    from .aggregates import principal_axis

    axis = principal_axis(df, by, x, y)
    p = df.join(axis, by).withColumn("_p", F.col(x) * F.col("ax") + F.col(y) * F.col("ay"))
    mid = p.groupBy(*by).agg(F.median("_p").alias("_m"), (F.max("_p") - F.min("_p") < 1e-12).alias("_flat"))
    rank = F.percent_rank().over(Window.partitionBy(*by).orderBy(order)) >= 0.5
    return p.join(mid, by).withColumn("half", F.when(F.col("_flat"), rank).otherwise(F.col("_p") > F.col("_m")).cast("int")).select(*df.columns, "half")


def densify(df: DataFrame, by: list[str], order: str, x: str, y: str, step: float) -> DataFrame:
    """Points of each group's polyline at most ``step`` apart; each edge starts at its first point."""
    w = Window.partitionBy(*by).orderBy(order)
    e = df.withColumn("_nx", F.lead(x).over(w)).withColumn("_ny", F.lead(y).over(w)).filter(F.col("_nx").isNotNull())
    length = F.sqrt((F.col("_nx") - F.col(x)) * (F.col("_nx") - F.col(x)) + (F.col("_ny") - F.col(y)) * (F.col("_ny") - F.col(y)))
    n = e.withColumn("_n", F.greatest(F.lit(1), F.ceil(length / step)).cast("int")).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    t = F.col("k") / F.col("_n")
    return n.select(*by, order, "k", (F.col(x) + (F.col("_nx") - F.col(x)) * t).alias("px"), (F.col(y) + (F.col("_ny") - F.col(y)) * t).alias("py"))


def commit_views(candidates: DataFrame, existing: DataFrame, by: list[str], order: str, position: list[str], angle: str, distance: float, turn: float, capacity: int) -> DataFrame:
    """Prune along the order, prune against existing views, then keep each group's first ``capacity``."""
    from .joins import not_near
    from .sequential import greedy_prune

    kept = greedy_prune(candidates, by, order, position, angle, distance, turn)
    fresh = not_near(candidates.join(kept, [*by, order], "left_semi"), existing, position, angle, distance, turn)
    n = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    return fresh.withColumn("_n", n).filter(F.col("_n") <= capacity).drop("_n")
