"""B: filters, predicates, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.names import role_of_name
from ..operators import filters as flt
from .registry import query, table

SPLIT_RULES = [
    ("AUTOMOBILE", 0, "prefix", "Customer#00000000", ["val", "test"]),
    ("AUTOMOBILE", 1, "all", "", ["train"]),
    ("BUILDING", 0, "name", "Customer#000000007", []),
    ("BUILDING", 1, "prefix", "Customer#0000001", ["test"]),
    ("BUILDING", 2, "all", "", ["train"]),
    ("FURNITURE", 0, "all", "", ["val", "test"]),
]


def scenes(spark, sf):
    """Suppliers stand for scenes."""
    return table(spark, sf, "supplier").select(F.col("s_name").alias("scene"), "s_suppkey", "s_nationkey")


@query("B01_scene_slice", "SELECT scene, s_suppkey, s_nationkey FROM (SELECT s_name scene, s_suppkey, s_nationkey, row_number() OVER (ORDER BY s_name) - 1 i, count(*) OVER () n FROM supplier) WHERE i >= 5 AND i < n - 10 AND (i - 5) % 3 = 0")
def scene_slice(spark, sf):
    return flt.slice_rows(scenes(spark, sf), 5, -10, 3)


@query("B01_scene_names", "SELECT s_name scene, s_suppkey FROM supplier WHERE s_name IN ('Supplier#000000003', 'Supplier#000000041', 'absent')")
def scene_names(spark, sf):
    return flt.named(scenes(spark, sf), ["Supplier#000000003", "Supplier#000000041", "absent"]).select("scene", "s_suppkey")


@query("B01_scene_exists", "SELECT s_name scene, s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)")
def scene_exists(spark, sf):
    present = table(spark, sf, "nation").filter("n_regionkey < 2").select(F.col("n_nationkey").alias("s_nationkey"))
    return flt.having(scenes(spark, sf), present, "s_nationkey").select("scene", "s_suppkey")


@query("B01_scene_exists_not", "SELECT s_name scene, s_suppkey FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)")
def scene_exists_not(spark, sf):
    present = table(spark, sf, "nation").filter("n_regionkey < 2").select(F.col("n_nationkey").alias("s_nationkey"))
    return flt.having(scenes(spark, sf), present, "s_nationkey", wanted=False).select("scene", "s_suppkey")


@query("B01_scene_state", "SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END = 'F'")
def scene_state(spark, sf):
    log = F.when(F.col("o_orderstatus") != "P", F.create_map(F.lit("depth"), F.struct(F.col("o_orderstatus").alias("state"))))
    return flt.in_state(table(spark, sf, "orders").withColumn("log", log), "log", "depth", "F").select("o_orderkey")


@query("B01_scene_state_not", "SELECT o_orderkey FROM orders WHERE CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END <> 'F'")
def scene_state_not(spark, sf):
    log = F.when(F.col("o_orderstatus") != "P", F.create_map(F.lit("depth"), F.struct(F.col("o_orderstatus").alias("state"))))
    return flt.in_state(table(spark, sf, "orders").withColumn("log", log), "log", "depth", "F", wanted=False).select("o_orderkey")


@query("B01_scene_regex", "SELECT s_name scene, s_suppkey FROM supplier WHERE regexp_full_match(s_name, 'Supplier#0+[1-3]7')")
def scene_regex(spark, sf):
    return flt.matching(scenes(spark, sf), "Supplier#0+[1-3]7").select("scene", "s_suppkey")


@query("B01_scene_chain", "SELECT scene, s_suppkey FROM (SELECT s_name scene, s_suppkey, row_number() OVER (ORDER BY s_name) i FROM supplier WHERE regexp_full_match(s_name, '.*[02468]') AND s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)) WHERE i <= 12")
def scene_chain(spark, sf):
    gone = table(spark, sf, "nation").filter("n_regionkey = 0").select(F.col("n_nationkey").alias("s_nationkey"))
    steps = [lambda d: flt.matching(d, ".*[02468]"), lambda d: flt.having(d, gone, "s_nationkey", wanted=False), lambda d: flt.slice_rows(d, 0, 12)]
    return flt.chain(scenes(spark, sf), steps).select("scene", "s_suppkey")


@query("B02_frame_prefix", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(?:Part 1[0-9])')")
def frame_prefix(spark, sf):
    return flt.matching(table(spark, sf, "part"), "Part 1[0-9]", "p_name", full=False).select("p_partkey", "p_name")


@query("B02_frame_exists", "SELECT doc_id FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def frame_exists(spark, sf):
    return flt.having(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")


@query("B02_frame_exists_not", "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def frame_exists_not(spark, sf):
    return flt.having(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id", wanted=False)


@query("B03_file_list", "WITH w(s, f) AS (VALUES (3, [1, 2]), (5, NULL), (7, [4])) SELECT l.l_orderkey AS scene, l.l_linenumber AS frame FROM lineitem l JOIN w ON l.l_orderkey = w.s AND (w.f IS NULL OR list_contains(w.f, l.l_linenumber))")
def file_list(spark, sf):
    wanted = spark.createDataFrame([(3, [1, 2]), (5, None), (7, [4])], "scene long, frames array<int>")
    frames = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("scene"), F.col("l_linenumber").alias("frame"))
    return frames.join(F.broadcast(wanted), "scene").filter(F.col("frames").isNull() | F.array_contains("frames", F.col("frame"))).select("scene", "frame")


@query("B04_modality", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'fine' WHEN p_size % 3 = 1 THEN 'depth' END literal, CASE WHEN p_size % 3 = 0 THEN 'fine' WHEN p_size % 3 = 1 THEN 'depth' ELSE 'image' END found FROM part")
def modality(spark, sf):
    names = F.when(F.col("p_size") % 3 == 0, F.array(F.lit("image"), F.lit("depth/fine"))).when(F.col("p_size") % 3 == 1, F.array(F.lit("image"), F.lit("depth"))).otherwise(F.array(F.lit("image")))
    literal = F.coalesce(flt.pick_modality(F.col("m"), "depth/fine"), flt.pick_modality(F.col("m"), "depth"))
    found = F.coalesce(flt.pick_modality(F.col("m"), "depth.*"), flt.pick_modality(F.col("m"), "im.ge"))
    return table(spark, sf, "part").withColumn("m", names).select("p_partkey", literal.alias("literal"), found.alias("found"))


@query("B05_scene_default", "SELECT o.o_orderkey, coalesce(nullif(o.o_totalprice > 100000, false)::INT * o.o_totalprice, c.c_acctbal) AS value FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
def scene_default(spark, sf):
    j = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    own = F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice"))
    return j.select("o_orderkey", flt.with_default(own, F.col("c_acctbal")).alias("value"))


@query("B06_remap", "SELECT r_regionkey AS id, r_name AS scene FROM region")
def remap(spark, sf):
    return flt.remap(table(spark, sf, "region"), {"r_regionkey": "id", "r_name": "scene", "absent": "x"})


@query("B07_weight_range", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount >= 0.02 AND l_discount < 0.07 - 1e-12::DOUBLE")
def weight_range(spark, sf):
    return table(spark, sf, "lineitem").filter(flt.weight_in(F.col("l_discount"), 0.02, 0.07)).select("l_orderkey", "l_linenumber", "l_discount")


@query("B08_in_image", "SELECT p_partkey FROM part WHERE p_size - 10 >= 0 AND p_retailprice - 950 >= 0 AND p_size - 10 < 30 AND p_retailprice - 950 < 640 AND p_size / 10.0 > 2.5")
def in_image(spark, sf):
    return table(spark, sf, "part").filter(flt.in_image(F.col("p_size") - 10, F.col("p_retailprice") - 950, F.col("p_size") / 10.0, 30, 640, 2.5)).select("p_partkey")


_PIXELS = "(SELECT vec_id, i - 1 AS i, embedding[i]::DOUBLE AS z FROM embeddings, range(1, 65) t(i))"


def pixels(spark, sf):
    """The 8x8 grids that stand for rasters: vec_id, i, y, x, z; values up to 0 are invalid."""
    e = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "z"))
    return e.select("vec_id", "i", F.floor(F.col("i") / 8).cast("int").alias("y"), (F.col("i") % 8).alias("x"), F.col("z").cast("double").alias("z"))


@query("B09_valid_depth", f"SELECT vec_id, count(*) AS n FROM {_PIXELS} WHERE z > 1e-6 GROUP BY 1")
def valid_depth(spark, sf):
    return pixels(spark, sf).filter(flt.valid_depth(F.col("z"), 1e-6)).groupBy("vec_id").agg(F.count(F.lit(1)).alias("n"))


@query("B10_mask_apply", f"SELECT vec_id, count(*) FILTER (z > 0) AS n_valid, count(*) FILTER (z <= 0) AS n_masked, round(sum(CASE WHEN z > 0 THEN z ELSE 0 END), 6) AS total FROM {_PIXELS} GROUP BY 1")
def mask_apply(spark, sf):
    ok = flt.valid_depth(F.col("z"))
    kept = F.when(ok, F.col("z")).otherwise(F.lit(0.0))
    return pixels(spark, sf).groupBy("vec_id").agg(F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_masked"), F.round(F.sum(kept), 6).alias("total"))


@query("B11_keep_views", f"""WITH v AS (SELECT vec_id, vec_id // 5 AS wp, avg(CASE WHEN z > 0 THEN 0.0 ELSE 1.0 END) AS bad FROM {_PIXELS} GROUP BY 1, 2),
 w AS (SELECT wp FROM v GROUP BY wp HAVING min(bad) <= 0.4) SELECT wp AS waypoint, dense_rank() OVER (ORDER BY wp) - 1 AS index FROM w""")
def keep_views(spark, sf):
    view = pixels(spark, sf).groupBy("vec_id").agg(F.avg(F.when(flt.valid_depth(F.col("z")), 0.0).otherwise(1.0)).alias("bad"))
    kept = view.groupBy(F.floor(F.col("vec_id") / 5).cast("long").alias("waypoint")).agg(F.min("bad").alias("best")).filter("best <= 0.4").select("waypoint")
    from ..operators.sequential import dense_index

    return dense_index(kept, "waypoint", "index")


@query("B12_quarantine", f"SELECT count(*) AS n_good, count(*) FILTER (bad) AS n_bad FROM (SELECT vec_id, bool_or(abs(z) > 0.4) AS bad FROM {_PIXELS} GROUP BY 1)")
def quarantine(spark, sf):
    bad = F.bool_or((F.abs(F.col("z")) > 0.4) | F.isnan("z") | F.col("z").isNull())
    return pixels(spark, sf).groupBy("vec_id").agg(bad.alias("bad")).agg(F.count(F.lit(1)).alias("n_good"), F.count_if("bad").alias("n_bad"))


@query("B13_split_rules", """WITH s AS (SELECT c_mktsegment AS dataset, c_name AS scene FROM customer),
 t AS (SELECT dataset, scene, CASE WHEN dataset = 'AUTOMOBILE' THEN CASE WHEN starts_with(scene, 'Customer#00000000') THEN ['val', 'test'] ELSE ['train'] END
  WHEN dataset = 'BUILDING' THEN CASE WHEN scene = 'Customer#000000007' THEN [] WHEN starts_with(scene, 'Customer#0000001') THEN ['test'] ELSE ['train'] END
  WHEN dataset = 'FURNITURE' THEN ['val', 'test'] ELSE [] END AS splits FROM s) SELECT dataset, scene, unnest(splits) AS split FROM t""")
def split_rules(spark, sf):
    rules = spark.createDataFrame(SPLIT_RULES, "dataset string, rule_order int, kind string, pattern string, splits array<string>")
    s = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("dataset"), F.col("c_name").alias("scene"))
    return flt.assign_splits(s, rules, repeats=True)


@query("B15_view_class", """WITH e AS (SELECT vec_id, embedding[4]::DOUBLE a, embedding[5]::DOUBLE b, embedding[6]::DOUBLE c FROM embeddings),
 g AS (SELECT vec_id, degrees(acos(greatest(-1.0, least(1.0, -c / greatest(sqrt(a*a + b*b + c*c), 1e-12))))) AS angle FROM e)
 SELECT vec_id, round(angle, 6) AS angle, CASE WHEN angle <= 35 THEN 'down' ELSE 'side' END AS label FROM g""")
def view_class(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", *[F.element_at("embedding", i).cast("double").alias(n) for i, n in ((4, "a"), (5, "b"), (6, "c"))])
    angle = flt.down_angle(F.col("a"), F.col("b"), F.col("c"))
    return e.select("vec_id", F.round(angle, 6).alias("angle"), flt.view_class(angle).alias("label"))


@query("B16_name_class", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'nadir' WHEN 1 THEN 'oblique' ELSE 'nadir2' END AS role FROM part")
def name_class(spark, sf):
    name = F.concat("p_name", F.when(F.col("p_size") % 3 == 0, "_nadir").when(F.col("p_size") % 3 == 1, "_oblique").otherwise("_nadir_2"))
    return table(spark, sf, "part").select("p_partkey", role_of_name(name).alias("role"))


@query("B14_settings", "SELECT 'root' AS name, 'cli' AS value UNION ALL SELECT 'topk', '7' UNION ALL SELECT 'min_covis', '0.1' UNION ALL SELECT 'overwrite', 'True' UNION ALL SELECT 'target_size', '224'")
def merged_settings(spark, sf):
    """Defaults, a settings text and a command line, the later ones first."""
    from ..functions import ranges
    from ..plans.loader import settings

    checks = {"root": str, "topk": ranges.positive_int, "overwrite": ranges.boolean}
    got = settings({"root": "a", "topk": 50, "min_covis": 0.25, "overwrite": False, "target_size": 224}, "root: b\nmin_covis: 0.1\ntarget_size:\n", ["--root=cli", "--topk", "7", "--overwrite"], checks)
    return spark.createDataFrame([(k, str(v)) for k, v in got.items()], "name string, value string")


@query("N07_ranges", "SELECT p_partkey, CASE WHEN p_size - 10 > 0 THEN (p_size - 10)::DOUBLE END AS positive, CASE WHEN p_size / 25.0::DOUBLE <= 1 THEN p_size / 25.0::DOUBLE END AS share, CASE WHEN p_size * 7 < 179 THEN (p_size * 7)::DOUBLE END AS fov FROM part")
def ranges_of_text(spark, sf):
    from ..functions.ranges import in_range

    s, inf = F.col("p_size"), float("inf")
    return table(spark, sf, "part").select("p_partkey", in_range((s - 10).cast("string"), 0, inf, low_open=True, whole=True).alias("positive"), in_range((s / F.lit(25.0)).cast("string"), 0, 1).alias("share"), in_range((s * 7).cast("string"), 0, 179, True, True).alias("fov"))
