"""C: joins, and the flagship view graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins
from ..plans import covisibility as cov
from .filtering import pixels
from .registry import query, table

_EDGES = """(WITH s AS (SELECT DISTINCT l_suppkey v, l_partkey p FROM lineitem), n AS (SELECT v, count(*) n FROM s GROUP BY 1)
 SELECT a.v AS src, b.v AS dst, count(*) AS shared, count(*) / greatest(any_value(n.n), 1)::DOUBLE AS w FROM s a JOIN s b ON a.p = b.p AND a.v <> b.v JOIN n ON n.v = b.v GROUP BY 1, 2)"""


def edges(spark, sf):
    return cov.shared_point_edges(table(spark, sf, "lineitem"), "l_suppkey", "l_partkey")


@query("C09_covisibility_topk", f"SELECT src, dst, round(w, 6) AS w, rank FROM (SELECT src, dst, w, row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) AS rank FROM {_EDGES} WHERE w >= 0.25) WHERE rank <= 10")
def covisibility_topk(spark, sf):
    return cov.strongest(edges(spark, sf), 10, 0.25).select("src", "dst", F.round("w", 6).alias("w"), "rank")


_CAMS = """(SELECT vec_id AS view, label AS scene, 6.0::DOUBLE AS f, 3.5::DOUBLE AS c, round(embedding[1]::DOUBLE, 3) AS tx, round(embedding[2]::DOUBLE, 3) AS ty FROM embeddings)"""
_PIX = "(SELECT vec_id AS view, label AS scene, (i - 1) // 8 AS row, (i - 1) % 8 AS col, round(abs(embedding[i]::DOUBLE) * 10, 3) AS z FROM embeddings, range(1, 65) t(i))"


@query("C09_depth_covisibility", f"""WITH cams AS {_CAMS}, pix AS {_PIX},
 cand AS (SELECT a.scene, a.view AS src, b.view AS dst FROM cams a JOIN cams b ON a.scene = b.scene AND a.view <> b.view),
 pts AS (SELECT p.scene, p.view AS src, (p.col - a.c) * p.z / a.f + a.tx AS wx, (p.row - a.c) * p.z / a.f + a.ty AS wy, p.z AS wz FROM pix p JOIN cams a ON p.view = a.view WHERE p.z > 0),
 prj AS (SELECT t.scene, t.src, k.dst, b.f * (t.wy - b.ty) / greatest(abs(t.wz), 1e-5) + b.c AS pr, b.f * (t.wx - b.tx) / greatest(abs(t.wz), 1e-5) + b.c AS pc, t.wz AS d FROM pts t JOIN cand k ON t.scene = k.scene AND t.src = k.src JOIN cams b ON b.view = k.dst),
 vis AS (SELECT *, least(round_even(pr, 0)::INT, 7) AS r, least(round_even(pc, 0)::INT, 7) AS c FROM prj WHERE pr >= 0 AND pc >= 0 AND pr < 8 AND pc < 8 AND d > 0.04)
 SELECT v.scene::INT AS scene, v.src, v.dst, round(count(*) / 64.0::DOUBLE, 6) AS w FROM vis v JOIN pix q ON q.view = v.dst AND q.row = v.r AND q.col = v.c WHERE abs(v.d - q.z) < 0.2 + 0.02 * v.d GROUP BY 1, 2, 3 HAVING count(*) / 64.0 >= 0.1""")
def depth_covisibility(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "label", "embedding")
    tx, ty = (F.round(F.element_at("embedding", i).cast("double"), 3) for i in (1, 2))
    one, zero = F.lit(1.0), F.lit(0.0)
    cams = e.select(F.col("label").alias("scene"), F.col("vec_id").alias("view"), *[F.lit(v).alias(n) for n, v in (("fx", 6.0), ("fy", 6.0), ("cx", 3.5), ("cy", 3.5), ("h", 8), ("w", 8))], F.array(one, zero, zero, tx, zero, one, zero, ty, zero, zero, one, zero, zero, zero, zero, one).alias("m"), F.array(one, zero, zero, -tx, zero, one, zero, -ty, zero, zero, one, zero, zero, zero, zero, one).alias("inv"))
    pix = e.select(F.col("label").alias("scene"), F.col("vec_id").alias("view"), F.posexplode("embedding").alias("i", "v")).select("scene", "view", F.floor(F.col("i") / 8).cast("int").alias("row"), (F.col("i") % 8).alias("col"), F.round(F.abs(F.col("v").cast("double")) * 10, 3).alias("z"))
    out = cov.depth_covisibility(pix, cams)
    return out.filter("w >= 0.1").select("scene", "src", "dst", F.round("w", 6).alias("w"))


@query("C01_common_stems", "SELECT o_orderkey AS stem, o_totalprice, n_lines FROM orders JOIN (SELECT l_orderkey, count(*) n_lines FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def common_stems(spark, sf):
    images = table(spark, sf, "orders").select(F.col("o_orderkey").alias("stem"), "o_totalprice", "o_custkey")
    cams = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("stem")).agg(F.count(F.lit(1)).alias("n_lines"))
    rich = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.common_stems(images, cams, key=["stem"]).join(rich, "o_custkey", "left_semi").select("stem", "o_totalprice", "n_lines")


@query("C02_optional_mask", "WITH j AS (SELECT d.doc_id, d.source, l.toxic, max(CASE WHEN l.toxic IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY d.source) AS ever FROM documents d LEFT JOIN labels l USING (doc_id)) SELECT doc_id, source, toxic, ever = 1 AS scene_has_mask FROM j")
def optional_mask(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", "left")
    used = d.groupBy("source").agg(F.bool_or(F.col("toxic").isNotNull()).alias("scene_has_mask"))
    return d.join(used, "source").select("doc_id", "source", "toxic", "scene_has_mask")


@query("C03_completeness", "SELECT coalesce(o.k, l.k) AS stem, o.k IS NOT NULL AS has_img, l.k IS NOT NULL AS has_cam FROM (SELECT o_orderkey k FROM orders WHERE o_orderkey % 7 <> 0) o FULL JOIN (SELECT DISTINCT l_orderkey k FROM lineitem) l ON o.k = l.k")
def completeness(spark, sf):
    img = table(spark, sf, "orders").filter("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("stem"))
    cam = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("stem"))
    return joins.completeness(["stem"], img=img, cam=cam)


@query("C04_dropped_stems", "SELECT o_orderkey AS stem FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def dropped_stems(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("stem")).join(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("stem")), "stem", "left_anti")


@query("C04_resume", "SELECT o_orderkey AS stem FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def resume(spark, sf):
    done = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("stem"))
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("stem")).join(done, "stem", "left_anti")


@query("C05_camera_lookup", "SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def camera_lookup(spark, sf):
    n = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf, "supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name", "r_name")


@query("C06_ordered_pairs", "SELECT a.s_nationkey AS scene, a.s_suppkey AS src, b.s_suppkey AS dst FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey")
def ordered_pairs(spark, sf):
    s = table(spark, sf, "supplier")
    a, b = (s.select(F.col("s_nationkey").alias("scene"), F.col("s_suppkey").alias(n)) for n in ("src", "dst"))
    return a.join(b, "scene").filter("src <> dst")


@query("C07_unordered_pairs", "SELECT a.s_nationkey AS scene, a.s_suppkey AS i, b.s_suppkey AS j FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def unordered_pairs(spark, sf):
    s = table(spark, sf, "supplier")
    a, b = (s.select(F.col("s_nationkey").alias("scene"), F.col("s_suppkey").alias(n)) for n in ("i", "j"))
    return a.join(b, "scene").filter("i < j")


@query("C08_sphere_prefilter", """WITH e AS (SELECT vec_id v, label scene, embedding[1]::DOUBLE x, embedding[2]::DOUBLE y, embedding[3]::DOUBLE z, 0.1 + abs(embedding[4]::DOUBLE) / 4 r FROM embeddings)
 SELECT a.scene, a.v AS src, b.v AS dst FROM e a JOIN e b ON a.scene = b.scene AND a.v < b.v WHERE (a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z) <= (a.r+b.r)*(a.r+b.r)""")
def sphere_prefilter(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("view"), F.col("label").alias("scene"), *[F.element_at("embedding", i).cast("double").alias(n) for i, n in ((1, "x"), (2, "y"), (3, "z"))], (0.1 + F.abs(F.element_at("embedding", 4).cast("double")) / 4).alias("r"))
    from ..operators.frustum import touching_spheres

    return touching_spheres(e, by="scene", cell=0.5)


@query("C10_asof", "SELECT p.event_id, c.value AS match, c.ts AS match_time FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT user_id, ts, arg_max(value, event_id) AS value FROM events WHERE event_type = 'click' GROUP BY 1, 2) c ON p.user_id = c.user_id AND p.ts >= c.ts")
def asof(spark, sf):
    e = table(spark, sf, "events")
    left = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.filter("event_type = 'click'").select("user_id", "ts", "value", F.col("event_id").alias("tie"))
    return joins.asof(left, right, ["user_id"], "ts", "value", "tie").select("event_id", "match", "match_time")


@query("C10_interpolation", """WITH k AS (SELECT DISTINCT user_id, epoch(ts)::DOUBLE / 86400 AS t FROM events WHERE event_type = 'click'), q AS (SELECT event_id, user_id, epoch(ts)::DOUBLE / 86400 AS t FROM events WHERE event_type = 'view'),
 j AS (SELECT q.*, (SELECT max(k.t) FROM k WHERE k.user_id = q.user_id AND k.t <= q.t) AS t0, (SELECT min(k.t) FROM k WHERE k.user_id = q.user_id AND k.t > q.t) AS t1 FROM q)
 SELECT event_id, round(CASE WHEN abs(t - t0) <= 1e-4 THEN 0.0 WHEN abs(t1 - t) <= 1e-4 THEN 1.0 WHEN t1 - t0 > 2.0 THEN NULL ELSE (t - t0) / (t1 - t0) END, 6) AS alpha FROM j""")
def interpolation(spark, sf):
    e = table(spark, sf, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 / 86400)
    out = joins.interpolation(e.filter("event_type = 'view'").select("event_id", "user_id", "t"), e.filter("event_type = 'click'"), ["user_id"], "t")
    return out.select("event_id", F.round("alpha", 6).alias("alpha"))


@query("C11_video_chunk", """WITH ch AS (SELECT user_id, event_id AS chunk, epoch(ts)::DOUBLE AS s, epoch(ts)::DOUBLE + 40000 + 1000 * (event_id % 50) AS e FROM events WHERE event_type = 'signup'),
 p AS (SELECT event_id, user_id, epoch(ts)::DOUBLE AS t FROM events WHERE event_type = 'view') SELECT p.event_id, min(ch.chunk) AS chunk FROM p JOIN ch ON p.user_id = ch.user_id AND p.t BETWEEN ch.s AND ch.e GROUP BY 1""")
def video_chunk(spark, sf):
    e = table(spark, sf, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    chunks = e.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("chunk"), F.col("t").alias("s"), (F.col("t") + 40000 + 1000 * (F.col("event_id") % 50)).alias("e"))
    points = e.filter("event_type = 'view'").select("event_id", "user_id", "t")
    return joins.in_interval(points, chunks, ["user_id"], "t", "s", "e", "chunk", 40000.0).select("event_id", "chunk")


@query("C12_replace_rows", "SELECT p.p_partkey, coalesce(u.x, p.p_size) AS p_size FROM part p LEFT JOIN (SELECT l_partkey k, max(l_linenumber)::INT + 100 x FROM lineitem WHERE l_discount > 0.09 GROUP BY 1) u ON p_partkey = k")
def replace_rows(spark, sf):
    new = table(spark, sf, "lineitem").filter("l_discount > 0.09").groupBy(F.col("l_partkey").alias("p_partkey")).agg((F.max("l_linenumber") + 100).alias("x"))
    return table(spark, sf, "part").join(new, "p_partkey", "left").select("p_partkey", F.coalesce("x", "p_size").alias("p_size"))


_KEPT = f"(SELECT src, dst, w FROM (SELECT src, dst, w, row_number() OVER (PARTITION BY src ORDER BY w DESC, dst) r FROM {_EDGES}) WHERE r <= 30)"


def kept_edges(spark, sf, k=30):
    return cov.strongest(edges(spark, sf), k, 0.0).select("src", "dst", "w")


@query("C13_symmetric_max", f"WITH e AS {_KEPT} SELECT a.src, a.dst, round(greatest(a.w, coalesce(b.w, 0)), 6) AS w FROM e a LEFT JOIN e b ON a.src = b.dst AND a.dst = b.src")
def symmetric_max(spark, sf):
    return joins.symmetric_max(kept_edges(spark, sf)).select("src", "dst", F.round("w", 6).alias("w"))


@query("C14_symmetric_mean", f"WITH k AS {_KEPT}, e AS (SELECT * FROM k UNION ALL SELECT s_suppkey, s_suppkey, 0.5 + (s_suppkey % 5) / 10.0::DOUBLE FROM supplier), p AS (SELECT src, dst FROM e WHERE src <> dst UNION SELECT dst, src FROM e WHERE src <> dst), s AS (SELECT p.src, p.dst, (coalesce(a.w, 0) + coalesce(b.w, 0)) / 2 / (d.w + 1e-8) AS w FROM p LEFT JOIN e a ON a.src = p.src AND a.dst = p.dst LEFT JOIN e b ON b.src = p.dst AND b.dst = p.src JOIN e d ON d.src = p.src AND d.dst = p.src) SELECT src, dst, round(w, 6) AS w FROM s WHERE w > 0.3")
def symmetric_mean(spark, sf):
    own = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("src"), F.col("s_suppkey").alias("dst"), (0.5 + (F.col("s_suppkey") % 5) / 10.0).alias("w"))
    return joins.symmetric_mean(kept_edges(spark, sf).unionByName(own), 0.3).select("src", "dst", F.round("w", 6).alias("w"))


def _expansion(spark, sf, policy):
    frames = table(spark, sf, "orders").select(F.col("o_orderkey").alias("frame_id"), (F.col("o_orderkey") % 5).alias("position"))
    views = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("frame_id"), F.col("l_linenumber").alias("cam_id"))
    return joins.expand_views(frames, views.distinct(), policy).select("frame_id", "cam_id")


_FRAMES = "(SELECT o_orderkey f, o_orderkey % 5 p FROM orders) x JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) y ON x.f = y.l_orderkey"


@query("C15_views_all", f"SELECT f AS frame_id, l_linenumber AS cam_id FROM {_FRAMES}")
def views_all(spark, sf):
    return _expansion(spark, sf, "all")


@query("C15_views_same", f"SELECT f AS frame_id, min(l_linenumber) AS cam_id FROM {_FRAMES} GROUP BY 1")
def views_same(spark, sf):
    return _expansion(spark, sf, "same")


@query("C15_views_cycle", f"SELECT f AS frame_id, l_linenumber AS cam_id FROM (SELECT f, p, l_linenumber, row_number() OVER (PARTITION BY f ORDER BY l_linenumber) - 1 r, count(*) OVER (PARTITION BY f) n FROM {_FRAMES}) WHERE r = p % n")
def views_cycle(spark, sf):
    return _expansion(spark, sf, "cycle")


_POINTS = "(SELECT vec_id, label, round(embedding[1]::DOUBLE, 3) x, round(embedding[2]::DOUBLE, 3) y, round(embedding[3]::DOUBLE, 3) z FROM embeddings)"


def centres(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", *[F.round(F.element_at("embedding", i).cast("double"), 3).alias(n) for i, n in ((1, "x"), (2, "y"), (3, "z"))])


@query("C16_nearest", f"SELECT label, arg_min(vec_id, (d, vec_id)) AS vec_id, round(sqrt(min(d)), 6) AS distance FROM (SELECT p.label, p.vec_id, (p.x-q.x)*(p.x-q.x) + (p.y-q.y)*(p.y-q.y) + (p.z-q.z)*(p.z-q.z) AS d FROM {_POINTS} p JOIN (SELECT label, 0.1 AS x, -0.1 AS y, label / 100.0::DOUBLE AS z FROM {_POINTS} GROUP BY label) q ON p.label = q.label) GROUP BY 1")
def nearest(spark, sf):
    p = centres(spark, sf)
    targets = p.select("label").distinct().select("label", F.lit(0.1).alias("x"), F.lit(-0.1).alias("y"), (F.col("label") / 100.0).alias("z"))
    return joins.nearest(p, targets, ["label"], ["x", "y", "z"], "vec_id").withColumn("distance", F.round("distance", 6))


@query("C17_redundancy", f"""WITH p AS (SELECT vec_id, x, y, (vec_id * 37) % 360 AS a FROM {_POINTS}), c AS (SELECT * FROM p WHERE vec_id % 2 = 0), e AS (SELECT * FROM p WHERE vec_id % 2 = 1)
 SELECT vec_id FROM c WHERE NOT EXISTS (SELECT 1 FROM e WHERE sqrt((c.x-e.x)*(c.x-e.x) + (c.y-e.y)*(c.y-e.y)) <= 0.05 AND least(abs(c.a-e.a) % 360, 360 - abs(c.a-e.a) % 360) <= 60)""")
def redundancy(spark, sf):
    p = centres(spark, sf).select("vec_id", "x", "y", (F.col("vec_id") * 37 % 360).alias("a"))
    return joins.not_near(p.filter("vec_id % 2 = 0"), p.filter("vec_id % 2 = 1"), ["x", "y"], "a", 0.05, 60).select("vec_id")


@query("C18_palette", "SELECT p_partkey, coalesce(r_name, 'unknown') AS label FROM part LEFT JOIN region ON p_size % 8 = r_regionkey")
def palette(spark, sf):
    lut = table(spark, sf, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("label"))
    return table(spark, sf, "part").withColumn("id", F.col("p_size") % 8).join(F.broadcast(lut), "id", "left").select("p_partkey", F.coalesce("label", F.lit("unknown")).alias("label"))
