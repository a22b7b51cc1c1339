"""J: rasters and point maps, on the 8x8 grids of the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import raster as ras
from .filtering import pixels
from .registry import query, table

# The grids with depth rounded, so that borders of tests are the same in both engines.
_P = "(SELECT vec_id, ((i - 1) // 8)::INT AS y, ((i - 1) % 8)::INT AS x, round(embedding[i]::DOUBLE * 10, 3) + 0.0 AS z FROM embeddings, range(1, 65) t(i))"
_CAM = "6.0::DOUBLE"


def grid(spark, sf):
    return pixels(spark, sf).select("vec_id", "y", "x", (F.round(F.col("z") * 10, 3) + 0.0).alias("z"))


def _r(df, *cols, n=6):
    return df.withColumns({c: F.round(c, n) + 0.0 for c in cols})


@query("J01_unproject", f"SELECT vec_id, y, x, round((x - 3.5) * z / {_CAM}, 6) + 0.0 AS px, round((y - 3.5) * z / {_CAM}, 6) + 0.0 AS py, z > 0 AS valid FROM {_P}")
def unproject(spark, sf):
    f, c = F.lit(6.0), F.lit(3.5)
    px, py, _ = ras.unproject(F.col("x"), F.col("y"), F.col("z"), f, f, c, c)
    return _r(grid(spark, sf).select("vec_id", "y", "x", px.alias("px"), py.alias("py"), (F.col("z") > 0).alias("valid")), "px", "py")


@query("J02_ray_depth", f"SELECT vec_id, y, x, round(z * sqrt(power((x - 3.5) / {_CAM}, 2) + power((y - 3.5) / {_CAM}, 2) + 1), 6) AS range FROM {_P} WHERE z > 0")
def ray_depth(spark, sf):
    f, c = F.lit(6.0), F.lit(3.5)
    d = ras.ray(F.col("x"), F.col("y"), f, f, c, c)
    return _r(grid(spark, sf).filter("z > 0").select("vec_id", "y", "x", (F.col("z") / d[2]).alias("range")), "range")


@query("J03_project", f"SELECT vec_id, y, x, round({_CAM} * (x - 3.5 + 1) * 1.0::DOUBLE / greatest(abs(z), 1e-5) + 3.5, 3) AS col FROM {_P} WHERE abs(z) > 0.1")
def project(spark, sf):
    from ..plans.covisibility import projected

    one, zero = F.lit(1.0), F.lit(0.0)
    eye = [one, zero, zero, one, zero, one, zero, zero, zero, zero, one, zero]
    _, col, _ = projected((F.col("x") - 3.5, F.col("y") - 3.5, F.col("z")), eye, F.lit(6.0), F.lit(6.0), F.lit(3.5), F.lit(3.5))
    return grid(spark, sf).filter(F.abs("z") > 0.1).select("vec_id", "y", "x", F.round(col, 3).alias("col"))


@query("J04_nearest_sample", f"WITH p AS MATERIALIZED {_P}, q AS MATERIALIZED (SELECT vec_id, greatest(0, least(7, round_even(x * 1.25 - 0.5, 0)::INT)) AS x, y, x AS k FROM p) SELECT q.vec_id, q.y, q.k, p.z FROM q JOIN p ON p.vec_id = q.vec_id AND p.y = q.y AND p.x = q.x")
def nearest_sample(spark, sf):
    g = grid(spark, sf)
    q = g.select("vec_id", "y", F.col("x").alias("k"), ras.nearest_pixel(F.col("x") * 1.25 - 0.5, 8).alias("x"))
    return q.join(g, ["vec_id", "y", "x"]).select("vec_id", "y", "k", "z")


@query("J05_sliding", f"WITH p AS (SELECT vec_id, y, x, z FROM {_P}), a AS (SELECT vec_id, y, x AS i, list(z) OVER (PARTITION BY vec_id, y ORDER BY x ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS w FROM p) SELECT vec_id, y, (i // 2)::BIGINT AS k, w FROM a WHERE i % 2 = 0 AND i // 2 < 3")
def sliding(spark, sf):
    return ras.sliding(grid(spark, sf), ["vec_id", "y"], "x", "z", 3, 2)


_WIN = "(PARTITION BY vec_id, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"
_COL = "(PARTITION BY vec_id, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"


def _pool(cols, source):
    """SQL of 3x3 max and min of a column."""
    return f"(SELECT *, max(rhi) OVER {_COL} AS hi, min(rlo) OVER {_COL} AS lo FROM (SELECT *, max({cols}) OVER {_WIN} AS rhi, min({cols}) OVER {_WIN} AS rlo FROM {source}))"


@query("J06_max_pool", f"SELECT vec_id, y, x, hi AS pooled FROM {_pool('z', _P)}")
def max_pool(spark, sf):
    return ras.window_2d(grid(spark, sf), ["vec_id"], "z", 1, F.max, "pooled").select("vec_id", "y", "x", "pooled")


@query("J07_depth_edge", f"SELECT vec_id, y, x, coalesce(hi - lo > 2.5, false) OR coalesce((hi - lo) / v > 1.5, false) AS edge FROM {_pool('v', f'(SELECT *, CASE WHEN z > 0 THEN z END AS v FROM {_P})')}")
def depth_edge(spark, sf):
    return ras.depth_edges(grid(spark, sf), ["vec_id"], "z", 2.5, 1.5).select("vec_id", "y", "x", "edge")


@query("J08_depth_aliasing", f"SELECT vec_id, y, x, least(hi - z, z - lo) > 1.2005 AS alias FROM {_pool('z', _P)}")
def depth_aliasing(spark, sf):
    return ras.depth_aliasing(grid(spark, sf), ["vec_id"], "z", 1.2005).select("vec_id", "y", "x", "alias")


_N = f"""(WITH p AS (SELECT vec_id, y, x, (x - 3.5) * v / 6 AS px, (y - 3.5) * v / 6 AS py, v AS pz FROM (SELECT vec_id, y, x, CASE WHEN z > 0 THEN z END AS v FROM {_P})),
 n AS (SELECT p.*, u.px - p.px ux, u.py - p.py uy, u.pz - p.pz uz, l.px - p.px lx, l.py - p.py ly, l.pz - p.pz lz, d.px - p.px dx, d.py - p.py dy, d.pz - p.pz dz, r.px - p.px rx, r.py - p.py ry, r.pz - p.pz rz FROM p LEFT JOIN p u ON u.vec_id = p.vec_id AND u.x = p.x AND u.y = p.y - 1 LEFT JOIN p l ON l.vec_id = p.vec_id AND l.y = p.y AND l.x = p.x - 1 LEFT JOIN p d ON d.vec_id = p.vec_id AND d.x = p.x AND d.y = p.y + 1 LEFT JOIN p r ON r.vec_id = p.vec_id AND r.y = p.y AND r.x = p.x + 1),
 c AS (SELECT vec_id, y, x, unnest([struct_pack(a := uy*lz-uz*ly, b := uz*lx-ux*lz, c := ux*ly-uy*lx), struct_pack(a := ly*dz-lz*dy, b := lz*dx-lx*dz, c := lx*dy-ly*dx), struct_pack(a := dy*rz-dz*ry, b := dz*rx-dx*rz, c := dx*ry-dy*rx), struct_pack(a := ry*uz-rz*uy, b := rz*ux-rx*uz, c := rx*uy-ry*ux)]) AS k FROM n),
 s AS (SELECT vec_id, y, x, sum(coalesce(k.a / nullif(sqrt(k.a*k.a + k.b*k.b + k.c*k.c), 0), 0)) a, sum(coalesce(k.b / nullif(sqrt(k.a*k.a + k.b*k.b + k.c*k.c), 0), 0)) b, sum(coalesce(k.c / nullif(sqrt(k.a*k.a + k.b*k.b + k.c*k.c), 0), 0)) c FROM c GROUP BY 1, 2, 3)
 SELECT vec_id, y, x, CASE WHEN sqrt(a*a+b*b+c*c) > 1e-12 THEN a / sqrt(a*a+b*b+c*c) END AS nx, CASE WHEN sqrt(a*a+b*b+c*c) > 1e-12 THEN b / sqrt(a*a+b*b+c*c) END AS ny, CASE WHEN sqrt(a*a+b*b+c*c) > 1e-12 THEN c / sqrt(a*a+b*b+c*c) END AS nz FROM s)"""


def normal_map(spark, sf):
    g = grid(spark, sf).withColumn("v", F.when(F.col("z") > 0, F.col("z")))
    p = g.select("vec_id", "y", "x", ((F.col("x") - 3.5) * F.col("v") / 6).alias("px"), ((F.col("y") - 3.5) * F.col("v") / 6).alias("py"), F.col("v").alias("pz"))
    return ras.normals(p, ["vec_id"])


@query("J09_normals", f"SELECT vec_id, y, x, round(nx, 4) + 0.0 AS nx, round(ny, 4) + 0.0 AS ny, round(nz, 4) + 0.0 AS nz FROM {_N}")
def normals(spark, sf):
    return normal_map(spark, sf).select("vec_id", "y", "x", *[(F.round(c, 4) + 0.0).alias(c) for c in ("nx", "ny", "nz")])


@query("J10_normal_edge", f"WITH n AS MATERIALIZED {_N} SELECT a.vec_id, a.y, a.x, coalesce(max(degrees(acos(greatest(-1.0, least(1.0, round(a.nx*b.nx + a.ny*b.ny + a.nz*b.nz, 9)))))) > 80.00005, false) AS edge FROM n a LEFT JOIN n b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY 1, 2, 3")
def normal_edge(spark, sf):
    n = normal_map(spark, sf)
    return normal_edges(n, ["vec_id"], 80.00005)


def normal_edges(n, keys, limit):
    """edge: the largest angle to a 3x3 neighbour's normal exceeds the limit; each pixel is sent to its nine places."""
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    sent = n.withColumn("o", around).select(*keys, (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"), *[F.col(c).alias(f"b{c}") for c in ("nx", "ny", "nz")])
    dot = sum((F.col(c) * F.col(f"b{c}") for c in ("ny", "nz")), F.col("nx") * F.col("bnx"))
    angle = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.round(dot, 9)))))
    return n.join(sent, [*keys, "y", "x"]).groupBy(*keys, "y", "x").agg(F.coalesce(F.max(angle) > limit, F.lit(False)).alias("edge"))


def _mirror(i, n=8):
    return f"CASE WHEN {i} < 0 THEN -({i}) WHEN {i} > {n - 1} THEN {2 * n - 2} - ({i}) ELSE {i} END"


@query("J11_sobel", f"""WITH p AS MATERIALIZED {_P}, k AS (SELECT * FROM (VALUES (-1, -1, -1, -1), (-1, 0, 0, -2), (-1, 1, 1, -1), (0, -1, -2, 0), (0, 1, 2, 0), (1, -1, -1, 1), (1, 0, 0, 2), (1, 1, 1, 1)) t(dy, dx, wx, wy))
 SELECT p.vec_id, p.y, p.x, round(sqrt(power(sum(wx * q.z), 2) + power(sum(wy * q.z), 2)), 4) AS gradient FROM p, k JOIN p q ON q.vec_id = p.vec_id AND q.y = {_mirror('p.y + k.dy')} AND q.x = {_mirror('p.x + k.dx')} GROUP BY 1, 2, 3""")
def sobel(spark, sf):
    return _r(ras.sobel(grid(spark, sf), ["vec_id"], "z", 8, 8).select("vec_id", "y", "x", "gradient"), "gradient", n=4)


@query("J12_dilate", f"SELECT vec_id, y, x, max(rm) OVER (PARTITION BY vec_id, x ORDER BY y ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m FROM (SELECT vec_id, y, x, max(CASE WHEN z > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY vec_id, y ORDER BY x ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS rm FROM {_P})")
def dilate(spark, sf):
    g = grid(spark, sf).select("vec_id", "y", "x", (F.col("z") > 2).cast("int").alias("m"))
    return ras.dilate(g, ["vec_id"], "m", 1, 2)


@query("J13_components", f"""WITH RECURSIVE p AS MATERIALIZED (SELECT vec_id, y, x FROM {_P} WHERE z > 1), e AS MATERIALIZED (SELECT a.vec_id, a.y * 100000 + a.x AS a, b.y * 100000 + b.x AS b FROM p a JOIN p b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
 r AS (SELECT vec_id, a, b FROM e UNION SELECT r.vec_id, r.a, e.b FROM r JOIN e ON e.vec_id = r.vec_id AND e.a = r.b), c AS (SELECT vec_id, a, min(b) AS component FROM r GROUP BY 1, 2)
 SELECT vec_id, (a // 100000)::INT AS y, (a % 100000)::INT AS x, component::BIGINT AS component, count(*) OVER (PARTITION BY vec_id, component) >= 4 AS kept FROM c""")
def components(spark, sf):
    g = grid(spark, sf).withColumn("m", (F.col("z") > 1).cast("int"))
    return ras.components(g, "vec_id", "m", 4)


@query("J14_area_mean", f"SELECT vec_id, (y // 2)::INT AS y, (x // 2)::INT AS x, round(coalesce(avg(z) FILTER (z > 0), 0), 5) AS z FROM {_P} GROUP BY 1, 2, 3")
def area_mean(spark, sf):
    return _r(ras.area_mean(grid(spark, sf), ["vec_id"], "z", 2), "z", n=5)


@query("J15_nearest_resize", f"SELECT vec_id, a::INT AS y, b::INT AS x, z FROM {_P}, range(0, 5) t(a), range(0, 5) u(b) WHERE y = floor(a * 8 / 5.0) AND x = floor(b * 8 / 5.0)")
def nearest_resize(spark, sf):
    at = F.explode(F.sequence(F.lit(0), F.lit(4)))
    ids = grid(spark, sf).select("vec_id").distinct().withColumn("a", at).withColumn("b", at)
    want = ids.select("vec_id", F.col("a"), F.col("b"), F.floor(F.col("a") * 8 / 5).cast("int").alias("y"), F.floor(F.col("b") * 8 / 5).cast("int").alias("x"))
    return want.join(grid(spark, sf), ["vec_id", "y", "x"]).select("vec_id", F.col("a").alias("y"), F.col("b").alias("x"), "z")


@query("J16_brown", f"SELECT vec_id, y, x, round(u * (1 + r2 * (0.1 + r2 * 0.01)) + 0.002 * u * v + 0.002 * (r2 + 2 * u * u), 6) AS dx FROM (SELECT *, u*u + v*v AS r2 FROM (SELECT vec_id, y, x, (x - 3.5) / 6.0::DOUBLE AS u, (y - 3.5) / 6.0::DOUBLE AS v FROM {_P}))")
def brown(spark, sf):
    u, v = (F.col("x") - 3.5) / 6, (F.col("y") - 3.5) / 6
    dx, _ = ras.brown_distortion(u, v, (0.1, 0.01, 0.0), (0.001, 0.002))
    return _r(grid(spark, sf).select("vec_id", "y", "x", dx.alias("dx")), "dx")


@query("J16_other_models", f"SELECT vec_id, y, x, round(u / (1 + 0.2 * r2), 6) AS division, round(atan(sqrt(r2)), 6) AS equidistant, round(2 * tan(atan(sqrt(r2)) / 2), 6) AS stereographic, round(2 * sin(atan(sqrt(r2)) / 2), 6) AS equisolid, round(sin(atan(sqrt(r2))), 6) AS orthographic FROM (SELECT *, u*u + v*v AS r2 FROM (SELECT vec_id, y, x, (x - 3.5) / 6.0::DOUBLE AS u, (y - 3.5) / 6.0::DOUBLE AS v FROM {_P}))")
def other_models(spark, sf):
    u, v = (F.col("x") - 3.5) / 6, (F.col("y") - 3.5) / 6
    models = ("equidistant", "stereographic", "equisolid", "orthographic")
    r = F.sqrt(u * u + v * v)
    d = grid(spark, sf).select("vec_id", "y", "x", ras.division_distortion(u, v, 0.2)[0].alias("division"), *[ras.fisheye_radius(r, m).alias(m) for m in models])
    return _r(d, "division", *models)


@query("J17_bilinear", f"""WITH p AS MATERIALIZED {_P}, q AS (SELECT vec_id, y AS k, x AS j, x * 0.9 + 0.3::DOUBLE AS u, y * 0.8 + 1.1::DOUBLE AS v FROM p), c AS (SELECT q.*, dy, dx, (CASE dy WHEN 1 THEN v - floor(v) ELSE 1 - (v - floor(v)) END) * (CASE dx WHEN 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) AS w FROM q, range(0, 2) a(dy), range(0, 2) b(dx))
 SELECT c.vec_id, k, j, round(sum(w * coalesce(p.z, 0)), 5) AS z FROM c LEFT JOIN p ON p.vec_id = c.vec_id AND p.y = floor(c.v) + c.dy AND p.x = floor(c.u) + c.dx GROUP BY 1, 2, 3""")
def bilinear(spark, sf):
    g = grid(spark, sf)
    q = g.select("vec_id", F.col("y").alias("k"), F.col("x").alias("j"), (F.col("x") * 0.9 + 0.3).alias("u"), (F.col("y") * 0.8 + 1.1).alias("v"))
    return _r(ras.bilinear(g, q, ["vec_id"], "z").select("vec_id", "k", "j", "z"), "z", n=5)


@query("J17_vignette", f"SELECT vec_id, y, x, round(z * greatest(0.0, least(1.0, 1 - 0.5 * (power(x - 3.5, 2) + power(y - 3.5, 2)) / 24.5)), 5) AS z FROM {_P}")
def vignette(spark, sf):
    r2 = (F.col("x") - 3.5) * (F.col("x") - 3.5) + (F.col("y") - 3.5) * (F.col("y") - 3.5)
    return _r(grid(spark, sf).withColumn("z", F.col("z") * ras.vignette(F.sqrt(r2), F.lit(24.5**0.5), 0.5)), "z", n=5)


@query("J18_rectify", f"""WITH RECURSIVE g AS MATERIALIZED (SELECT vec_id, (x - 3.5) / 6.0::DOUBLE AS x, (y - 3.5) / 6.0::DOUBLE AS y FROM {_P}), d AS (SELECT DISTINCT x, y FROM g),
 s AS (SELECT x, y, x AS ux, y AS uy, 0 AS i FROM d UNION ALL SELECT x, y, (x - 0.002 * ux * uy - 0.002 * (r2 + 2 * ux * ux)) / (1 + r2 * (0.1 + r2 * 0.01)), (y - 0.001 * (r2 + 2 * uy * uy) - 0.004 * ux * uy) / (1 + r2 * (0.1 + r2 * 0.01)), i + 1 FROM (SELECT *, ux*ux + uy*uy AS r2 FROM s) WHERE i < 60)
 SELECT g.vec_id, round(g.x, 6) + 0.0 AS x, round(g.y, 6) + 0.0 AS y, round(ux, 6) + 0.0 AS ux, round(uy, 6) + 0.0 AS uy FROM g JOIN s ON s.x = g.x AND s.y = g.y AND s.i = 60""")
def rectify(spark, sf):
    g = grid(spark, sf).select("vec_id", ((F.col("x") - 3.5) / 6).alias("x"), ((F.col("y") - 3.5) / 6).alias("y"))
    return _r(ras.rectified(g, "vec_id", (0.1, 0.01, 0.0), (0.001, 0.002)), "x", "y", "ux", "uy")


@query("J18_rectified_image", f"""WITH p AS MATERIALIZED {_P}, n AS (SELECT *, u*u + v*v AS r2 FROM (SELECT vec_id, y, x, (x - 3.5) / 6.0::DOUBLE AS u, (y - 3.5) / 6.0::DOUBLE AS v FROM p)),
 q AS MATERIALIZED (SELECT vec_id, y, x, (u * (1 + r2 * (0.1 + r2 * 0.01)) + 0.002 * u * v + 0.002 * (r2 + 2 * u * u)) * 6 + 3.5 AS u, (v * (1 + r2 * (0.1 + r2 * 0.01)) + 0.001 * (r2 + 2 * v * v) + 0.004 * u * v) * 6 + 3.5 AS v FROM n),
 c AS (SELECT q.*, dy, dx, (CASE dy WHEN 1 THEN v - floor(v) ELSE 1 - (v - floor(v)) END) * (CASE dx WHEN 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) AS w FROM q, range(0, 2) a(dy), range(0, 2) b(dx))
 SELECT c.vec_id, c.y, c.x, u >= 0 AND v >= 0 AND u <= 7 AND v <= 7 AS valid, CASE WHEN u >= 0 AND v >= 0 AND u <= 7 AND v <= 7 THEN round(sum(w * coalesce(p.z, 0)), 5) + 0.0 END AS z FROM c LEFT JOIN p ON p.vec_id = c.vec_id AND p.y = floor(c.v) + c.dy AND p.x = floor(c.u) + c.dx GROUP BY c.vec_id, c.y, c.x, u, v""")
def rectified_image(spark, sf):
    out = ras.rectified_image(grid(spark, sf), "vec_id", "z", 6.0, 6.0, 3.5, 3.5, (0.1, 0.01, 0.0), (0.001, 0.002), 8, 8)
    return _r(out, "z", n=5)


@query("J19_distorted_points", f"SELECT vec_id, y, x, round(z * (u * (1 + r2 * 0.1)) + 1e-9, 5) AS px FROM (SELECT *, u*u + v*v AS r2 FROM (SELECT vec_id, y, x, z, (x - 3.5) / 6.0::DOUBLE AS u, (y - 3.5) / 6.0::DOUBLE AS v FROM {_P})) WHERE z > 0")
def distorted_points(spark, sf):
    dx, _ = ras.brown_distortion((F.col("x") - 3.5) / 6, (F.col("y") - 3.5) / 6, (0.1, 0.0, 0.0), (0.0, 0.0))
    return _r(grid(spark, sf).filter("z > 0").select("vec_id", "y", "x", (F.col("z") * dx + 1e-9).alias("px")), "px", n=5)


@query("J20_fusion", f"SELECT a.vec_id, a.y, a.x, CASE WHEN a.z > 0 THEN a.z WHEN b.z > 0 THEN b.z ELSE 0 END AS z FROM {_P} a JOIN {_P} b ON b.vec_id = a.vec_id + 1 AND b.y = a.y AND b.x = a.x")
def fusion(spark, sf):
    g = grid(spark, sf)
    b = g.select((F.col("vec_id") - 1).alias("vec_id"), "y", "x", F.col("z").alias("zb"))
    return g.join(b, ["vec_id", "y", "x"]).select("vec_id", "y", "x", ras.fuse(F.col("z"), F.col("zb")).alias("z"))


@query("J21_vector_angle", f"SELECT vec_id, y, x, round(degrees(atan2(sqrt(power((y - 3.5), 2) + power((x - 3.5), 2)), z)), 4) AS angle, round(ln(1 + abs(z)), 6) AS lg FROM {_P}")
def vector_angle(spark, sf):
    from ..functions.camera import vector_angle as angle

    a = angle((F.col("x") - 3.5, F.col("y") - 3.5, F.col("z")), (F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    return grid(spark, sf).select("vec_id", "y", "x", F.round(F.degrees(a), 4).alias("angle"), F.round(F.log1p(F.abs("z")), 6).alias("lg"))


@query("J22_ragged_stack", """WITH v AS (SELECT label, vec_id, list_transform(embedding[1:(2 + vec_id % 5)::INT], lambda x: round(x::DOUBLE, 5)) AS v FROM embeddings), m AS (SELECT label, max(len(v)) AS n FROM v GROUP BY 1)
 SELECT label, list(len(v)::INT ORDER BY vec_id) AS lengths, list(list_resize(v, n) ORDER BY vec_id) AS stack FROM v JOIN m USING (label) GROUP BY 1""")
def ragged_stack(spark, sf):
    e = table(spark, sf, "embeddings").select("label", "vec_id", F.transform(F.slice("embedding", F.lit(1), (2 + F.col("vec_id") % 5).cast("int")), lambda x: F.round(x.cast("double"), 5)).alias("v"))
    return ras.stacked(e, ["label"], "vec_id", "v").select("label", "lengths", "stack")


@query("J23_denormalise", f"SELECT vec_id, y, x, floor(255 * greatest(0.0, least(1.0, z * 0.229 + 0.485)))::INT AS u8 FROM {_P}")
def denormalise(spark, sf):
    v = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("z") * 0.229 + 0.485))
    return grid(spark, sf).select("vec_id", "y", "x", F.floor(255 * v).cast("int").alias("u8"))
