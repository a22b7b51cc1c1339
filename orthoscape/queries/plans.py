"""N, P: names and flight planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import planning as pln
from .joining import _POINTS, centres
from .registry import query, table


@query("N01_camera_of_name", "SELECT p_partkey, 'scene_' || p_size AS rig, CASE WHEN p_size % 2 = 0 THEN 'n' ELSE 'f' END AS camera FROM part")
def camera_of_name(spark, sf):
    tag = F.when(F.col("p_size") % 2 == 0, "CAM_N").otherwise("rig-F")
    rig, cam = names.camera_of_name(F.concat(tag, F.lit("-scene_"), F.col("p_size").cast("string"), F.lit("_")), [r"cam_([a-z])(?=[-_])", r"rig-([a-z])(?=[-_])"])
    return table(spark, sf, "part").select("p_partkey", rig.alias("rig"), cam.alias("camera"))


_STEM = "(SELECT o_orderkey, 'A' || o_orderkey || '_' || o_custkey || '_B' AS s FROM orders)"


def stems(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("A"), F.col("o_orderkey").cast("string"), F.lit("_"), F.col("o_custkey").cast("string"), F.lit("_B")).alias("s"))


@query("N02_time_camera", f"SELECT o_orderkey, substr(s, 2) AS t1, left(s, 1) AS c1, left(s, length(s) - 1) AS t2, right(s, 1) AS c2, split_part(s, '_', 1) || '_' || split_part(s, '_', 3) AS t3, split_part(s, '_', 2) AS c3 FROM {_STEM}")
def time_camera(spark, sf):
    out = {}
    for i, how in enumerate(("first_char", "last_char", "split"), 1):
        out[f"t{i}"], out[f"c{i}"] = names.split_time_camera(F.col("s"), how)
    return stems(spark, sf).select("o_orderkey", *[c.alias(n) for n, c in out.items()])


@query("N03_stems", "SELECT o_orderkey, 'img_' || o_orderkey AS stem, '.jpg' AS ext, lpad((o_custkey % 10000)::VARCHAR, 4, '0') || '_' || lpad(o_orderkey::VARCHAR, 8, '0') AS padded FROM orders")
def stem(spark, sf):
    path = F.concat(F.lit("scene/images/img_"), F.col("o_orderkey").cast("string"), F.lit(".JPG"))
    return table(spark, sf, "orders").select("o_orderkey", names.stem(path).alias("stem"), names.extension(path).alias("ext"), names.padded(F.col("o_custkey") % 10000, F.col("o_orderkey")).alias("padded"))


@query("N04_float_list", "SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN [p_size::DOUBLE, p_retailprice, -1.5] END::DOUBLE[] AS numbers FROM part")
def float_list(spark, sf):
    text = F.concat_ws(" ", F.col("p_size").cast("string"), F.col("p_retailprice").cast("string"), F.when(F.col("p_size") % 5 == 0, "x1").otherwise("-1.5"))
    return table(spark, sf, "part").select("p_partkey", names.float_list(text).alias("numbers"))


@query("N05_matrix_shape", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN [p_size, p_size + 1] END::INT[] AS shape FROM part")
def matrix_shape(spark, sf):
    n = F.col("p_size")
    name = F.concat(F.lit("covis--"), n.cast("string"), F.when(n % 3 == 0, "x").otherwise("_"), (n + 1).cast("string"), F.lit(".npy"))
    return table(spark, sf, "part").select("p_partkey", names.matrix_shape(name).alias("shape"))


@query("N06_json", "SELECT event_id, (props->>'k')::BIGINT AS k, '{\"id\":' || event_id || '}' AS encoded FROM events")
def json(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"))).alias("encoded"))


@query("N08_time_stamps", "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def time_stamps(spark, sf):
    return table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMdd_HHmmss").alias("stamp"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))


@query("P01_spacing", "SELECT p_partkey, round(2 * (50.0::DOUBLE + p_size) * tan(radians(60.0) / 2), 6) AS swath, round(greatest(0.2, 2 * (50.0::DOUBLE + p_size) * tan(radians(60.0) / 2) * (1 - 0.8::DOUBLE)), 6) AS lane FROM part")
def spacing(spark, sf):
    h, f = 50.0 + F.col("p_size"), F.lit(60.0)
    return table(spark, sf, "part").select("p_partkey", F.round(pln.swath(h, f), 6).alias("swath"), F.round(pln.spacing(h, f, 0.8), 6).alias("lane"))


@query("P02_waypoints", "SELECT p_partkey, greatest(1, ceil(p_retailprice / (p_size * 0.75::DOUBLE)))::BIGINT AS n FROM part")
def waypoints(spark, sf):
    return table(spark, sf, "part").select("p_partkey", pln.waypoint_estimate(F.col("p_retailprice"), F.col("p_size"), 0.75).alias("n"))


def quads(spark, sf):
    """Four-sided polygons from points: a box of varied sides, with one corner cut in."""
    c = centres(spark, sf).select("vec_id", (F.floor(F.col("x") * 10) + 20).alias("x"), (F.floor(F.col("y") * 10) + 20).alias("y"), (10 + F.col("vec_id") % 7).cast("double").alias("w"), (8 + F.col("vec_id") % 5).cast("double").alias("h"))
    at = [(F.col("x"), F.col("y")), (F.col("x") + F.col("w"), F.col("y")), (F.col("x") + F.col("w") - 2, F.col("y") + F.col("h")), (F.col("x"), F.col("y") + F.col("h"))]
    p = F.posexplode(F.array(*[F.struct(a.cast("double").alias("x"), b.cast("double").alias("y")) for a, b in at]))
    return c.select("vec_id", p.alias("i", "p")).select("vec_id", "i", "p.x", "p.y")


_QUAD = f"(SELECT vec_id, floor(x * 10) + 20 AS x, floor(y * 10) + 20 AS y, (10 + vec_id % 7)::DOUBLE AS w, (8 + vec_id % 5)::DOUBLE AS h FROM {_POINTS})"


@query("P03_lawnmower", f"""WITH q AS (SELECT vec_id, x, y, w, h, w >= h AS wide FROM {_QUAD}), l AS (SELECT *, k AS lane_no FROM q, range(0, 12) t(k)),
 s AS (SELECT vec_id, wide, lane_no, CASE WHEN wide THEN y + lane_no * 3.0 ELSE x + lane_no * 3.0 END AS at_, CASE WHEN wide THEN x ELSE y END AS lo,
  CASE WHEN wide THEN x + w - 2 * (lane_no * 3.0) / h ELSE CASE WHEN lane_no * 3.0 < w - 2 THEN y + h ELSE y + h * (w - lane_no * 3.0) / 2 END END AS hi, CASE WHEN wide THEN lane_no * 3.0 < h - 1e-12 ELSE lane_no * 3.0 < w - 1e-12 END AS inside FROM l),
 g AS (SELECT * FROM s WHERE inside AND hi - lo >= 0.35 * 2.5), p AS (SELECT *, CASE WHEN lane_no % 2 = 1 THEN hi - k * 2.5 ELSE lo + k * 2.5 END AS along FROM g, range(0, 12) t(k) WHERE k <= floor((hi - lo + 1e-9) / 2.5))
 SELECT vec_id, lane_no::INT AS lane_no, k::INT AS k, round((CASE WHEN wide THEN along ELSE at_ END)::DOUBLE, 4) AS px, round((CASE WHEN wide THEN at_ ELSE along END)::DOUBLE, 4) AS py FROM p""")
def lawnmower(spark, sf):
    r = pln.lawnmower(quads(spark, sf), "vec_id", 3.0, 2.5)
    return r.select("vec_id", "lane_no", "k", F.round("px", 4).alias("px"), F.round("py", 4).alias("py"))


@query("P04_region", f"SELECT label, round(min(x) - (max(x) - min(x)) * 0.1, 6) AS x0, round(max(x) + (max(x) - min(x)) * 0.1, 6) AS x1, round(min(y) - (max(y) - min(y)) * 0.1, 6) AS y0, round(max(y) + (max(y) - min(y)) * 0.1, 6) AS y1 FROM {_POINTS} GROUP BY 1")
def region(spark, sf):
    return pln.region(centres(spark, sf), ["label"], "x", "y", 0.1).select("label", *[F.round(c, 6).alias(c) for c in ("x0", "x1", "y0", "y1")])


@query("P05_rig", "SELECT s_suppkey, cam, yaw FROM supplier, (VALUES ('N', 0.0::DOUBLE), ('F', 0.0), ('R', 90.0), ('B', 180.0), ('L', 270.0)) t(cam, yaw)")
def rig(spark, sf):
    return pln.rig_views(table(spark, sf, "supplier").select("s_suppkey"))


@query("P06_two_way_split", f"""WITH m AS (SELECT label, var_samp(x) a, covar_samp(x, y) b, var_samp(y) c FROM {_POINTS} GROUP BY 1), t AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l FROM m),
 u AS (SELECT label, b * sign(b) / sqrt(b*b + (l-a)*(l-a)) AS ax, (l - a) * sign(b) / sqrt(b*b + (l-a)*(l-a)) AS ay FROM t), p AS (SELECT q.label, vec_id, x * ax + y * ay AS v FROM {_POINTS} q JOIN u USING (label)),
 d AS (SELECT label, median(v) AS m FROM p GROUP BY 1) SELECT vec_id, (v > m)::INT AS half FROM p JOIN d USING (label)""")
def two_way_split(spark, sf):
    return pln.two_way_split(centres(spark, sf), ["label"], "x", "y", "vec_id").select("vec_id", "half")


@query("P07_densify", f"""WITH s AS (SELECT label, vec_id, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM {_POINTS} WINDOW w AS (PARTITION BY label ORDER BY vec_id)), n AS (SELECT *, greatest(1, ceil(sqrt((nx-x)*(nx-x) + (ny-y)*(ny-y)) / 0.15))::INT AS n FROM s WHERE nx IS NOT NULL)
 SELECT label, vec_id, k::INT AS k, round(x + (nx - x) * (k / n::DOUBLE), 5) AS px FROM n, range(0, 40) t(k) WHERE k < n""")
def densify(spark, sf):
    return pln.densify(centres(spark, sf), ["label"], "vec_id", "x", "y", 0.15).select("label", "vec_id", "k", F.round("px", 5).alias("px"))


@query("P08_display", f"SELECT p.vec_id, round((p.x - x0) / greatest(x1 - x0, 1e-9), 6) AS x FROM {_POINTS} p JOIN (SELECT label, min(x) x0, max(x) x1 FROM {_POINTS} GROUP BY 1) USING (label)")
def display(spark, sf):
    p = centres(spark, sf)
    box = p.groupBy("label").agg(F.min("x").alias("x0"), F.max("x").alias("x1"))
    return p.join(box, "label").select("vec_id", F.round((F.col("x") - F.col("x0")) / F.greatest(F.col("x1") - F.col("x0"), F.lit(1e-9)), 6).alias("x"))


@query("P09_retarget", "SELECT s_suppkey, f::DOUBLE AS fov, round(100 * tan(radians(60.0) / 2) / tan(radians(f) / 2), 6) AS height FROM supplier, (VALUES (40.0::DOUBLE), (60.0), (80.0)) t(f)")
def retarget(spark, sf):
    from ..functions.camera import same_footprint

    s = table(spark, sf, "supplier").select("s_suppkey", F.explode(F.array(*map(F.lit, (40.0, 60.0, 80.0)))).alias("fov"))
    return s.select("s_suppkey", "fov", F.round(same_footprint(F.lit(100.0), F.lit(60.0), F.col("fov")), 6).alias("height"))


@query("P10_commit_views", f"""WITH RECURSIVE c AS MATERIALIZED (SELECT label, vec_id, x, y, (vec_id * 37) % 360 AS a, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i FROM {_POINTS} WHERE vec_id % 3 <> 0), e AS MATERIALIZED (SELECT x, y, (vec_id * 37) % 360 AS a FROM {_POINTS} WHERE vec_id % 3 = 0),
 w AS (SELECT label, i, x, y, a, vec_id AS pick FROM c WHERE i = 1 UNION ALL
  SELECT label, i, CASE WHEN far THEN nx ELSE x END, CASE WHEN far THEN ny ELSE y END, CASE WHEN far THEN na ELSE a END, CASE WHEN far THEN vec_id END FROM
   (SELECT c.label, c.i, c.vec_id, w.x, w.y, w.a, c.x AS nx, c.y AS ny, c.a AS na, sqrt((c.x-w.x)*(c.x-w.x) + (c.y-w.y)*(c.y-w.y)) > 0.05 OR least(abs(c.a-w.a) % 360, 360 - abs(c.a-w.a) % 360) > 30 AS far FROM w JOIN c ON c.label = w.label AND c.i = w.i + 1)),
 k AS (SELECT label, pick AS vec_id, x, y, a FROM w WHERE pick IS NOT NULL), f AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM k WHERE NOT EXISTS (SELECT 1 FROM e WHERE sqrt((k.x-e.x)*(k.x-e.x) + (k.y-e.y)*(k.y-e.y)) <= 0.05 AND least(abs(k.a-e.a) % 360, 360 - abs(k.a-e.a) % 360) <= 30))
 SELECT label, vec_id FROM f WHERE n <= 12""")
def commit_views(spark, sf):
    p = centres(spark, sf).withColumn("a", F.col("vec_id") * 37 % 360)
    new, old = p.filter("vec_id % 3 <> 0"), p.filter("vec_id % 3 = 0")
    return pln.commit_views(new, old, ["label"], "vec_id", ["x", "y"], "a", 0.05, 30.0, 12).select("label", "vec_id")


@query("P11_tile_cache", "SELECT s_suppkey AS tile, s_acctbal AS area, CASE WHEN s_suppkey % 3 = 0 THEN 'cached' ELSE 'computed' END AS origin FROM supplier")
def tile_cache(spark, sf):
    tiles = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("tile"), F.col("s_acctbal").alias("area"))
    known = tiles.filter("tile % 3 = 0").withColumn("origin", F.lit("cached"))
    return known.unionByName(tiles.join(known, "tile", "left_anti").withColumn("origin", F.lit("computed")))
