"""D: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from .filtering import _PIXELS, pixels
from .joining import _EDGES, _POINTS, centres, edges
from .registry import query, table

_VIEW = "(SELECT l_suppkey AS scene, l_orderkey, l_linenumber, 1000 + l_quantity * 10 AS w, p_retailprice / 2 AS fx FROM lineitem JOIN part ON l_partkey = p_partkey)"


def views(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return j.select(F.col("l_suppkey").alias("scene"), "l_orderkey", "l_linenumber", (1000 + F.col("l_quantity") * 10).alias("w"), (F.col("p_retailprice") / 2).alias("fx"))


@query("D01_hfov_per_scene", f"SELECT scene, list_sort(list(DISTINCT round_even(degrees(2 * atan(w / (2 * fx))), 0)::INT)) AS hfovs FROM {_VIEW} GROUP BY 1")
def hfov_per_scene(spark, sf):
    v = views(spark, sf)
    return v.groupBy("scene").agg(F.sort_array(F.collect_set(F.bround(agg.field_of_view(F.col("w"), F.col("fx")), 0).cast("int"))).alias("hfovs"))


@query("D02_scene_stats", "SELECT l_suppkey AS scene, count(*) AS n_frames, arg_max(l_quantity, (l_orderkey, l_linenumber)) AS last_w FROM lineitem GROUP BY 1")
def scene_stats(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("scene")).agg(F.count(F.lit(1)).alias("n_frames"), F.max_by("l_quantity", F.struct("l_orderkey", "l_linenumber")).alias("last_w"))


@query("D03_run_summary", "SELECT c_mktsegment AS dataset, count(*) FILTER (o_orderstatus = 'F') AS generated, count(*) FILTER (o_orderstatus = 'O') AS skipped, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS failed FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ROLLUP (c_mktsegment)")
def run_summary(spark, sf):
    j = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("c_mktsegment", "dataset")
    s = F.col("o_orderstatus")
    return j.rollup("dataset").agg(F.count_if(s == "F").alias("generated"), F.count_if(s == "O").alias("skipped"), F.count_if(~s.isin("F", "O")).alias("failed"))


@query("D04_score", f"SELECT src, dst, round(least(1.0, greatest(0.0, w)), 6) AS score FROM {_EDGES}")
def score(spark, sf):
    return edges(spark, sf).select("src", "dst", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("w"))), 6).alias("score"))


@query("D05_near_far", f"SELECT vec_id, coalesce(min(z) FILTER (z > 0.1), 0) AS near, coalesce(max(z) FILTER (z > 0.1), 0) AS far FROM {_PIXELS} GROUP BY 1")
def near_far(spark, sf):
    ok = F.when(F.col("z") > 0.1, F.col("z"))
    return pixels(spark, sf).groupBy("vec_id").agg(F.coalesce(F.min(ok), F.lit(0.0)).alias("near"), F.coalesce(F.max(ok), F.lit(0.0)).alias("far"))


@query("D06_masked_mean", f"SELECT vec_id, round(avg(z) FILTER (z > 0.2), 6) AS mean, avg(z) FILTER (z > 0.2) IS NOT NULL AS valid FROM {_PIXELS} GROUP BY 1")
def masked_mean(spark, sf):
    m = agg.masked_mean(F.col("z"), F.col("z") > 0.2)
    return pixels(spark, sf).groupBy("vec_id").agg(F.round(m, 6).alias("mean"), m.isNotNull().alias("valid"))


@query("D07_nonzero_mean_scale", f"WITH f AS (SELECT vec_id, greatest(sum(CASE WHEN z > 0 THEN z ELSE 0 END) / (count(*) FILTER (z > 0) + 1e-8), 1e-8) AS factor FROM {_PIXELS} GROUP BY 1) SELECT p.vec_id, p.i::INT AS i, round(p.z / f.factor, 6) AS scaled FROM {_PIXELS} p JOIN f USING (vec_id)")
def nonzero_mean_scale(spark, sf):
    return agg.normalised_by_nonzero_mean(pixels(spark, sf), ["vec_id"], "z", "scaled").select("vec_id", F.col("i").cast("int").alias("i"), F.round("scaled", 6).alias("scaled"))


@query("D07_log_norm", f"SELECT label, round(sum(ln(1 + sqrt(x*x + y*y + z*z))) / (count(*) + 1e-8), 6) AS factor FROM {_POINTS} GROUP BY 1")
def log_norm(spark, sf):
    norm = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    return centres(spark, sf).groupBy("label").agg(F.round(F.sum(F.log1p(norm)) / (F.count(F.lit(1)) + 1e-8), 6).alias("factor"))


@query("D08_mode", "SELECT scene, a, b FROM (SELECT l_suppkey AS scene, l_quantity AS a, l_linenumber AS b, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, min(l_orderkey * 10 + l_linenumber)) r FROM lineitem GROUP BY 1, 2, 3) WHERE r = 1")
def mode(spark, sf):
    l = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("scene"), F.col("l_quantity").alias("a"), F.col("l_linenumber").alias("b"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"))
    return agg.mode_first_seen(l, ["scene"], ["a", "b"], "o")


@query("D09_origin_offset", f"SELECT label, round(avg(x), 6) AS mx, round(arg_min(x, vec_id), 6) AS fx, round(min(x), 6) AS lo, round(max(x), 6) AS hi FROM {_POINTS} GROUP BY 1")
def origin_offset(spark, sf):
    return centres(spark, sf).groupBy("label").agg(F.round(F.avg("x"), 6).alias("mx"), F.round(F.min_by("x", "vec_id"), 6).alias("fx"), F.round(F.min("x"), 6).alias("lo"), F.round(F.max("x"), 6).alias("hi"))


@query("D10_robust_tolerance", "WITH m AS (SELECT event_type, median(value) AS med FROM events GROUP BY 1) SELECT e.event_type, round(any_value(m.med), 6) AS med, round(median(abs(e.value - m.med)), 6) AS mad, round(any_value(m.med) + 3 * median(abs(e.value - m.med)), 6) AS tolerance FROM events e JOIN m USING (event_type) GROUP BY 1")
def robust_tolerance(spark, sf):
    return agg.robust_tolerance(table(spark, sf, "events"), ["event_type"], "value", 3.0).select("event_type", *[F.round(c, 6).alias(c) for c in ("med", "mad", "tolerance")])


@query("D11_percentile", f"SELECT vec_id, round(quantile_cont(z, 0.98), 6) AS threshold FROM {_PIXELS} GROUP BY 1")
def percentile(spark, sf):
    return pixels(spark, sf).groupBy("vec_id").agg(F.round(F.percentile("z", 0.98), 6).alias("threshold"))


@query("D12_principal_axis", f"""WITH m AS (SELECT label, var_samp(x) a, covar_samp(x, y) b, var_samp(y) c FROM {_POINTS} GROUP BY 1), t AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l FROM m),
 u AS (SELECT label, l, b / sqrt(b*b + (l-a)*(l-a)) AS x, (l - a) / sqrt(b*b + (l-a)*(l-a)) AS y FROM t) SELECT label, round(CASE WHEN x < 0 THEN -x ELSE x END, 6) AS ax, round(CASE WHEN x < 0 THEN -y ELSE y END, 6) AS ay, round(l, 6) AS variance FROM u""")
def principal_axis(spark, sf):
    return agg.principal_axis(centres(spark, sf), ["label"], "x", "y").select("label", *[F.round(c, 6).alias(c) for c in ("ax", "ay", "variance")])


@query("D13_depth_stats", f"SELECT vec_id % 10 AS scene, vec_id AS file, count(*) AS total, count(*) FILTER (z > 0) AS valid, count(*) FILTER (z > 0 AND z <= 0.05) AS removed FROM {_PIXELS} GROUP BY ROLLUP (scene, file)")
def depth_stats(spark, sf):
    p = pixels(spark, sf).select((F.col("vec_id") % 10).alias("scene"), F.col("vec_id").alias("file"), "z")
    return p.rollup("scene", "file").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("z") > 0).alias("valid"), F.count_if((F.col("z") > 0) & (F.col("z") <= 0.05)).alias("removed"))


@query("D14_finite_min_threshold", f"WITH m AS (SELECT vec_id, min(z) FILTER (z > 1e-6) + 0.05 AS thr FROM {_PIXELS} GROUP BY 1) SELECT p.vec_id, round(any_value(thr), 6) AS threshold, count(*) FILTER (p.z <= thr) AS removed, count(*) FILTER (p.z > thr) AS left_over FROM {_PIXELS} p JOIN m USING (vec_id) GROUP BY 1")
def finite_min_threshold(spark, sf):
    p = pixels(spark, sf)
    thr = p.groupBy("vec_id").agg((F.min(F.when(F.col("z") > 1e-6, F.col("z"))) + 0.05).alias("thr"))
    return p.join(thr, "vec_id").groupBy("vec_id").agg(F.round(F.first("thr"), 6).alias("threshold"), F.count_if(F.col("z") <= F.col("thr")).alias("removed"), F.count_if(F.col("z") > F.col("thr")).alias("left_over"))


@query("D15_tile_groups", "SELECT s_nationkey % 5 AS group_id, min(s_acctbal) AS x0, max(s_acctbal) AS x1, round(sum(s_acctbal), 2) AS area, list_sort(list(s_suppkey)) AS tiles FROM supplier GROUP BY 1")
def tile_groups(spark, sf):
    s = table(spark, sf, "supplier").withColumn("group_id", F.col("s_nationkey") % 5)
    return s.groupBy("group_id").agg(F.min("s_acctbal").alias("x0"), F.max("s_acctbal").alias("x1"), F.round(F.sum("s_acctbal"), 2).alias("area"), F.sort_array(F.collect_list("s_suppkey")).alias("tiles"))


@query("D16_tile_bounds", f"SELECT label, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1, round(max(x) - min(x), 6) AS dx, round(max(z) - min(z), 6) AS dz, count(*) AS n FROM {_POINTS} GROUP BY 1")
def tile_bounds(spark, sf):
    return centres(spark, sf).groupBy("label").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"), F.round(F.max("x") - F.min("x"), 6).alias("dx"), F.round(F.max("z") - F.min("z"), 6).alias("dz"), F.count(F.lit(1)).alias("n"))


@query("D17_auc", "WITH e AS (SELECT event_type, value / 10 AS e FROM events), n AS (SELECT event_type, count(*) n FROM events GROUP BY 1), t AS (SELECT unnest(range(0, 30)) AS k) SELECT n.event_type, round(avg(c), 6) AS auc FROM (SELECT n.event_type, t.k, (SELECT count(*) FROM e WHERE e.event_type = n.event_type AND e.e >= 0 AND e.e <= 30 AND least(floor(e.e), 29) <= t.k) / n.n::DOUBLE AS c FROM n, t) x JOIN n USING (event_type) GROUP BY 1")
def auc(spark, sf):
    e = table(spark, sf, "events").withColumn("e", F.col("value") / 10)
    return agg.auc_of_errors(e, ["event_type"], "e", 30).select("event_type", F.round("auc", 6).alias("auc"))


_GT = "(SELECT l_suppkey AS scene, l_extendedprice AS gt, CASE WHEN l_linenumber = 7 THEN 0 ELSE l_quantity * p_retailprice * (1 + l_discount - 0.05) END AS pred FROM lineitem JOIN part ON l_partkey = p_partkey)"


def gt_pred(spark, sf):
    j = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    pred = F.when(F.col("l_linenumber") == 7, 0.0).otherwise(F.col("l_quantity") * F.col("p_retailprice") * (1 + F.col("l_discount") - 0.05))
    return j.select(F.col("l_suppkey").alias("scene"), F.col("l_extendedprice").alias("gt"), pred.alias("pred"))


@query("D18_inlier_ratio", f"SELECT scene, round(avg(CASE WHEN pred > 0 AND greatest(gt / pred, pred / gt) < 1.03 THEN 1.0 ELSE 0.0 END), 6) AS inliers FROM {_GT} WHERE gt > 0 GROUP BY 1")
def inlier_ratio(spark, sf):
    return gt_pred(spark, sf).groupBy("scene").agg(F.round(agg.inlier_ratio(F.col("gt"), F.col("pred"), 1.03), 6).alias("inliers"))


@query("D19_relative_error", f"SELECT scene, round(avg(abs(gt - pred) / gt), 6) AS rel FROM {_GT} WHERE gt > 0 GROUP BY 1")
def relative_error(spark, sf):
    return gt_pred(spark, sf).groupBy("scene").agg(F.round(agg.mean_relative_error(F.col("gt"), F.col("pred")), 6).alias("rel"))


@query("D20_trajectory_error")
def trajectory_error(spark, sf):
    c = centres(spark, sf).select("label", "x", "y", "z", (0.6 * F.col("x") - 0.8 * F.col("y") + 1).alias("px"), (0.8 * F.col("x") + 0.6 * F.col("y")).alias("py"), (F.col("z") + 0.01 * (F.col("vec_id") % 3)).alias("pz"))
    return agg.trajectory_error(c, "label", ("x", "y", "z"), ("px", "py", "pz"))


@query("D21_rig_groups", "SELECT event_id, dense_rank() OVER (PARTITION BY user_id ORDER BY d) - 1 AS frame_id, format('cam{:03d}', dense_rank() OVER (PARTITION BY user_id ORDER BY event_type)) AS cam_id FROM (SELECT event_id, user_id, event_type, date_trunc('day', ts) AS d FROM events)")
def rig_groups(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.date_trunc("day", "ts").alias("d"))
    return agg.rig_groups(e, ["user_id"], "d", "event_type").select("event_id", "frame_id", "cam_id")


@query("D22_strips", "SELECT strftime(o_orderdate, '%m')::BIGINT AS strip, count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY 1")
def strips(spark, sf):
    from ..functions.names import numeric_prefix

    name = F.concat_ws("_", F.date_format("o_orderdate", "MM"), F.col("o_orderkey").cast("string"))
    return table(spark, sf, "orders").groupBy(numeric_prefix(name).alias("strip")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"))


@query("D23_status_counts", "SELECT l_returnflag AS role, count(*) FILTER (l_linestatus = 'F') AS saved, count(*) FILTER (l_linestatus = 'O') AS skipped FROM lineitem GROUP BY 1")
def status_counts(spark, sf):
    p = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("role")).pivot("l_linestatus", ["F", "O"]).count()
    return p.select("role", F.coalesce("F", F.lit(0)).alias("saved"), F.coalesce("O", F.lit(0)).alias("skipped"))


@query("D24_meters", "SELECT event_type, round(sum(value) / count(*), 6) AS global_avg, max(value) AS max_value, arg_max(value, (ts, event_id)) AS last_value FROM events GROUP BY 1")
def meters(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.round(F.sum("value") / F.count("value"), 6).alias("global_avg"), F.max("value").alias("max_value"), F.max_by("value", F.struct("ts", "event_id")).alias("last_value"))


@query("D25_polygon", f"""WITH p AS (SELECT label, vec_id, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny FROM {_POINTS} WINDOW w AS (PARTITION BY label ORDER BY vec_id))
 SELECT label, round(abs(sum(x * ny - nx * y)) / 2, 6) AS area, round(sum((x + nx) * (x * ny - nx * y)) / (3 * sum(x * ny - nx * y)), 4) AS cx FROM p GROUP BY 1""")
def polygon(spark, sf):
    return agg.polygon(centres(spark, sf), ["label"], "vec_id", "x", "y").select("label", F.round("area", 6).alias("area"), F.round("cx", 4).alias("cx"))


@query("D25_convex_hull", f"""WITH p AS MATERIALIZED (SELECT DISTINCT label::BIGINT AS label, round(x * 1000)::BIGINT AS x, round(y * 1000)::BIGINT AS y FROM {_POINTS}),
 e AS (SELECT a.label, a.x, a.y FROM p a JOIN p b ON a.label = b.label AND (a.x <> b.x OR a.y <> b.y) WHERE NOT EXISTS (SELECT 1 FROM p c WHERE c.label = a.label AND ((b.x-a.x)*(c.y-a.y) - (b.y-a.y)*(c.x-a.x) < 0
  OR ((b.x-a.x)*(c.y-a.y) - (b.y-a.y)*(c.x-a.x) = 0 AND (c.x-a.x)*(c.x-b.x) + (c.y-a.y)*(c.y-b.y) > 0)))),
 m AS (SELECT *, avg(x) OVER w AS mx, avg(y) OVER w AS my, count(*) OVER w AS n FROM e WINDOW w AS (PARTITION BY label)), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY atan2(y - my, x - mx)) AS r, row_number() OVER (PARTITION BY label ORDER BY x, y) AS first FROM m),
 f AS (SELECT label, r AS r0 FROM r WHERE first = 1) SELECT r.label, ((r - r0 + n) % n)::INT AS i, x / 1000.0::DOUBLE AS x, y / 1000.0::DOUBLE AS y FROM r JOIN f ON f.label = r.label""")
def convex_hull(spark, sf):
    return agg.convex_hulls(centres(spark, sf), "label", "x", "y")


@query("D26_ray_focal", "SELECT l_suppkey AS scene, round(regr_slope(l_extendedprice, l_quantity), 4) AS focal, round(regr_intercept(l_extendedprice, l_quantity), 3) AS centre FROM lineitem GROUP BY 1")
def ray_focal(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("scene")).agg(F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("focal"), F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 3).alias("centre"))


@query("D27_gradient_norm", "SELECT event_type, round(sqrt(sum(value * value)), 4) AS l2, max(abs(value)) AS inf FROM events GROUP BY 1")
def gradient_norm(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.round(F.sqrt(F.sum(F.col("value") * F.col("value"))), 4).alias("l2"), F.max(F.abs("value")).alias("inf"))
