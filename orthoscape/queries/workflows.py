"""Whole workflows and the remaining operators: storage round trips, triangle tests, random expansion, loaders, depth cleaning."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.rng import uniform
from ..plans import depth_filter, loader
from ..sources import catalog
from ..sources.shared import shared_dir
from .joining import kept_edges
from .rasters import _P, grid
from .registry import query, table


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/stored-{uuid.uuid4().hex[:12]}"


@query("A01_format_dispatch", "SELECT 'orc' AS format, count(*) AS n, sum(n_nationkey)::BIGINT AS total FROM nation UNION ALL SELECT 'json', count(*), sum(n_nationkey)::BIGINT FROM nation UNION ALL SELECT 'parquet', count(*), sum(n_nationkey)::BIGINT FROM nation")
def format_dispatch(spark, sf):
    at, out = _folder(spark), None
    n = table(spark, sf, "nation").select("n_nationkey")
    for name, suffix in (("orc", "orc"), ("json", "jsonl"), ("parquet", "parquet")):
        catalog.store(n, f"{at}/nation.{suffix}")
        d = catalog.load(spark, f"{at}/nation.{suffix}").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("n_nationkey").cast("long")).alias("total")).select(F.lit(name).alias("format"), "n", "total")
        out = d if out is None else out.unionByName(d)
    return out


@query("A02_json_documents", "SELECT r_regionkey AS id, r_name AS name FROM region")
def json_documents(spark, sf):
    at = _folder(spark)
    table(spark, sf, "region").select(F.to_json(F.struct(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))).alias("value")).coalesce(1).write.text(f"{at}/docs.json")
    return spark.read.schema("id int, name string").json(f"{at}/docs.json")


@query("A03_scene_meta", "SELECT s_nationkey::BIGINT AS scene, s_name AS frame_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name) - 1 AS place FROM supplier")
def scene_meta(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").cast("long").alias("scene"), F.col("s_name").alias("frame_name"), F.col("s_acctbal").alias("fx"))
    docs = catalog.scene_metadata(s, ["scene"], "frame_name", ["fx"])
    path = f"{_folder(spark)}/scene_meta.json"
    catalog.store_metadata(docs, path)
    catalog.store_metadata(docs, path)
    back = catalog.load_metadata(spark, path, docs.drop("frame_names").schema)
    return back.select("scene", F.explode("frame_names").alias("frame_name", "place")).withColumn("place", F.col("place").cast("long"))


_U = "('0x' || substr(md5('{s}|' || {k}), 1, 13))::BIGINT::DOUBLE / 4503599627370496"


@query("C15_views_random", f"SELECT f AS frame_id, l_linenumber AS cam_id FROM (SELECT l_orderkey AS f, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS r, count(*) OVER (PARTITION BY l_orderkey) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) WHERE r = floor({_U.format(s=21, k='f')} * n)")
def views_random(spark, sf):
    v = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("frame_id"), F.col("l_linenumber").alias("cam_id")).distinct()
    w = Window.partitionBy("frame_id")
    ranked = v.withColumn("r", F.row_number().over(w.orderBy("cam_id")) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    return ranked.filter(F.col("r") == F.floor(uniform(21, F.col("frame_id")) * F.col("n"))).select("frame_id", "cam_id")


_RAY = "(SELECT vec_id, embedding[1]::DOUBLE * 2 AS ox, embedding[2]::DOUBLE * 2 AS oy, -1.0::DOUBLE AS oz, embedding[3]::DOUBLE AS dx, embedding[4]::DOUBLE AS dy, 2.0::DOUBLE AS dz FROM embeddings)"


@query("K03_segment_triangle", f"SELECT vec_id, ox + dx / 2 >= 0 AND oy + dy / 2 >= 0 AND ox + dx / 2 + oy + dy / 2 <= 0.4 AS hit FROM {_RAY}")
def segment_triangle(spark, sf):
    """Segments from z = -1 to z = 1 against the triangle (0,0,0), (0.4,0,0), (0,0.4,0)."""
    from ..operators.frustum import segment_hits

    v = lambda i: F.element_at("embedding", i).cast("double")
    e = table(spark, sf, "embeddings").select("vec_id", (v(1) * 2).alias("ox"), (v(2) * 2).alias("oy"), v(3).alias("dx"), v(4).alias("dy"))
    start = (F.col("ox"), F.col("oy"), F.lit(-1.0))
    end = (F.col("ox") + F.col("dx"), F.col("oy") + F.col("dy"), F.lit(1.0))
    z, s = F.lit(0.0), F.lit(0.4)
    return e.select("vec_id", segment_hits(start, end, (z, z, z), (s, z, z), (z, s, z)).alias("hit"))


def _volume(p, a, b, c) -> str:
    """SQL of the signed volume of four points (triples of SQL terms)."""
    u, v, w = ([f"(({x}) - ({y}))" for x, y in zip(q, p, strict=True)] for q in (a, b, c))
    return f"({u[0]} * ({v[1]} * {w[2]} - {v[2]} * {w[1]}) - {u[1]} * ({v[0]} * {w[2]} - {v[2]} * {w[0]}) + {u[2]} * ({v[0]} * {w[1]} - {v[1]} * {w[0]}))"


def _crossing(p, q, a, b, c) -> str:
    """SQL: the ends of p-q lie on different sides of a triangle, and p-q passes its three edges on the same side."""
    left, right = _volume(p, a, b, c), _volume(q, a, b, c)
    sides = [_volume(p, q, x, y) for x, y in ((a, b), (b, c), (c, a))]
    same = " OR ".join("(" + " AND ".join(f"{s} {op} 0" for s in sides) + ")" for op in ("<=", ">="))
    return f"({left} * {right} < 0 AND ({same}))"


def _triangles_cross(x, y) -> str:
    return " OR ".join(_crossing(one[i], one[(i + 1) % 3], *other) for one, other in ((x, y), (y, x)) for i in range(3))


_UPRIGHT = (("ox", "oy", "-1.0"), ("ox", "oy", "1.0"), ("ox + 0.3", "oy", "1.0"))
_FLAT = (("0.0", "0.0", "0.0"), ("0.4", "0.0", "0.0"), ("0.0", "0.4", "0.0"))


@query("K04_triangle_pairs", f"SELECT vec_id, {_triangles_cross(_UPRIGHT, _FLAT)} AS hit FROM (SELECT vec_id, ox, oy FROM {_RAY})")
def triangle_pairs(spark, sf):
    """Upright triangles, which cross z = 0 from (ox, oy) to (ox + 0.15, oy), against the triangle of K03."""
    from ..operators.frustum import triangles_hit

    v = lambda i: F.element_at("embedding", i).cast("double") * 2
    x, y, z, s = v(1), v(2), F.lit(0.0), F.lit(0.4)
    upright = ((x, y, F.lit(-1.0)), (x, y, F.lit(1.0)), (x + 0.3, y, F.lit(1.0)))
    return table(spark, sf, "embeddings").select("vec_id", triangles_hit(upright, ((z, z, z), (s, z, z), (z, s, z))).alias("hit"))


@query("L01_view_records")
def view_records(spark, sf):
    edges = kept_edges(spark, sf).withColumn("scene", F.lit(0).cast("long"))
    own = loader.config({"dataset": "stand-in", "metric_scale": True, "synthetic": False}, {"mode": "tree", "high": 0.4, "low": None})
    samples = table(spark, sf, "supplier").select(F.lit(0).cast("long").alias("scene"), F.col("s_suppkey").cast("long").alias("sample"))
    chosen = loader.sampled_views(own, edges, samples, 6, 3)
    frames = table(spark, sf, "supplier").select(F.lit(0).cast("long").alias("scene"), F.col("s_suppkey").alias("view"), *[F.lit(x).alias(n) for n, x in (("fx", 6.0), ("fy", 6.0), ("cx", 3.5), ("cy", 3.5))])
    return loader.view_records(own, chosen, frames, grid(spark, sf).withColumnRenamed("vec_id", "view"))


@query("Q01_filter_depth")
def filter_depth(spark, sf):
    _, stats = depth_filter.filter_depth(grid(spark, sf), "vec_id", offset=0.1)
    return stats


@query("Q01_threshold_stats", f"WITH t AS (SELECT vec_id, min(z) FILTER (z > 1e-6) + 0.1 AS thr FROM {_P} GROUP BY 1) SELECT p.vec_id, count(*) AS total_pixels, count(*) FILTER (p.z > 0) AS valid_before, count(*) FILTER (p.z <= thr) AS threshold_removed FROM {_P} p JOIN t USING (vec_id) GROUP BY 1")
def threshold_stats(spark, sf):
    return filter_depth(spark, sf).select("vec_id", "total_pixels", "valid_before", "threshold_removed")
