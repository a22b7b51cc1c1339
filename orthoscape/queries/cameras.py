"""I, K, M: cameras, frustums and pose metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import camera as cam
from ..operators import frustum
from .joining import _POINTS, centres
from .registry import query, table

# Poses of the embeddings: a quaternion from four values and a centre from three.
_Q = """(SELECT vec_id, label, qx / n AS qx, qy / n AS qy, qz / n AS qz, qw / n AS qw, x, y, z FROM (SELECT vec_id, label, round(embedding[5]::DOUBLE, 4) AS qx, round(embedding[6]::DOUBLE, 4) AS qy, round(embedding[7]::DOUBLE, 4) AS qz, 1 + round(embedding[8]::DOUBLE, 4) AS qw,
 sqrt(power(round(embedding[5]::DOUBLE, 4), 2) + power(round(embedding[6]::DOUBLE, 4), 2) + power(round(embedding[7]::DOUBLE, 4), 2) + power(1 + round(embedding[8]::DOUBLE, 4), 2)) AS n, round(embedding[1]::DOUBLE, 4) AS x, round(embedding[2]::DOUBLE, 4) AS y, round(embedding[3]::DOUBLE, 4) AS z FROM embeddings))"""
_R = f"""(SELECT *, 1 - 2 * (qy*qy + qz*qz) AS r00, 2 * (qx*qy - qz*qw) AS r01, 2 * (qx*qz + qy*qw) AS r02, 2 * (qx*qy + qz*qw) AS r10, 1 - 2 * (qx*qx + qz*qz) AS r11, 2 * (qy*qz - qx*qw) AS r12, 2 * (qx*qz - qy*qw) AS r20, 2 * (qy*qz + qx*qw) AS r21, 1 - 2 * (qx*qx + qy*qy) AS r22 FROM {_Q})"""


def poses(spark, sf):
    """vec_id, label, unit quaternion q (struct), centre x y z, rotation rot (9), pose m (16, camera to world)."""
    v = lambda i: F.round(F.element_at("embedding", i).cast("double"), 4)
    e = table(spark, sf, "embeddings").select("vec_id", "label", v(5).alias("a"), v(6).alias("b"), v(7).alias("c"), (1 + v(8)).alias("d"), v(1).alias("x"), v(2).alias("y"), v(3).alias("z"))
    n = F.sqrt(F.col("a") * F.col("a") + F.col("b") * F.col("b") + F.col("c") * F.col("c") + F.col("d") * F.col("d"))
    u = e.select("vec_id", "label", "x", "y", "z", *[(F.col(s) / n).alias(t) for s, t in zip("abcd", ("qx", "qy", "qz", "qw"), strict=True)])
    r = u.withColumn("rot", cam.quaternion_to_rotation(quat()))
    g = lambda i: F.get("rot", F.lit(i))
    m = F.array(g(0), g(1), g(2), F.col("x"), g(3), g(4), g(5), F.col("y"), g(6), g(7), g(8), F.col("z"), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    return r.withColumn("m", m)


def quat(prefix=""):
    return tuple(F.col(f"{prefix}{c}") for c in ("qx", "qy", "qz", "qw"))


def _rounded(df, keys, exprs):
    return df.select(*keys, *[F.round(x, 6).alias(n) for n, x in exprs.items()])


@query("I01_hfov", "SELECT p_partkey, round(degrees(2 * atan(1000 / (2 * p_retailprice))), 6) AS hfov, round_even(degrees(2 * atan(1000 / (2 * p_retailprice))), 0)::INT AS hfov_int FROM part")
def hfov(spark, sf):
    h = cam.hfov(F.lit(1000.0), F.col("p_retailprice"))
    return table(spark, sf, "part").select("p_partkey", F.round(h, 6).alias("hfov"), F.bround(h, 0).cast("int").alias("hfov_int"))


@query("I02_focal", "SELECT p_partkey, round(1000 / (2 * tan(radians(20 + p_size) / 2)), 6) AS focal, round(50 * tan(radians(60.0::DOUBLE) / 2) / tan(radians(20 + p_size) / 2), 6) AS distance FROM part")
def focal(spark, sf):
    f = (20 + F.col("p_size")).cast("double")
    return _rounded(table(spark, sf, "part"), ["p_partkey"], {"focal": cam.focal(F.lit(1000.0), f), "distance": cam.same_footprint(F.lit(50.0), F.lit(60.0), f)})


@query("I03_pinhole", "SELECT p_partkey, [p_retailprice, 0.0, p_size::DOUBLE, 0.0, p_retailprice + 1, p_size / 2.0::DOUBLE, 0.0, 0.0, 1.0]::DOUBLE[] AS k FROM part")
def pinhole(spark, sf):
    s = F.col("p_size").cast("double")
    return table(spark, sf, "part").select("p_partkey", cam.pinhole(F.lit("PINHOLE"), F.col("p_retailprice"), F.col("p_retailprice") + 1, s, s / 2, F.lit(0.0)).alias("k"))


@query("I04_colmap_models", "SELECT p_partkey, p_retailprice * 0.5 AS fx, CASE WHEN p_size % 2 = 0 THEN p_size * 0.5 ELSE p_retailprice * 0.5 END AS fy, (CASE WHEN p_size % 2 = 0 THEN 3.5 ELSE p_size * 0.5 END)::DOUBLE AS cx, (CASE WHEN p_size % 2 = 0 THEN 4.5 ELSE 3.5 END)::DOUBLE AS cy FROM (SELECT p_partkey, p_retailprice, p_size::DOUBLE AS p_size0, p_size FROM part)")
def colmap_models(spark, sf):
    p = table(spark, sf, "part")
    model = F.when(F.col("p_size") % 2 == 0, "PINHOLE").otherwise("SIMPLE_RADIAL")
    fx, fy, cx, cy = cam.colmap_intrinsics(model, F.array(F.col("p_retailprice"), F.col("p_size").cast("double"), F.lit(7.0), F.lit(9.0)), 0.5)
    return p.select("p_partkey", fx.alias("fx"), fy.alias("fy"), cx.alias("cx"), cy.alias("cy"))


@query("I05_inverse", f"SELECT vec_id, round(r10, 6) AS i01, round(-(r00*x + r10*y + r20*z), 6) AS tx, round(-(r02*x + r12*y + r22*z), 6) AS tz FROM {_R}")
def inverse(spark, sf):
    p = poses(spark, sf).withColumn("i", cam.inverse_rigid(F.col("m")))
    return _rounded(p, ["vec_id"], {"i01": cam.at(F.col("i"), 0, 1), "tx": cam.at(F.col("i"), 0, 3), "tz": cam.at(F.col("i"), 2, 3)})


@query("I05_inverse_upper", "SELECT p_partkey, round(1 / p_retailprice, 9) AS a, round(-0.5 / (p_retailprice * (p_retailprice + 1)), 9) AS b, round((0.5 * 3 - p_size * (p_retailprice + 1)) / (p_retailprice * (p_retailprice + 1)), 9) AS c FROM part")
def inverse_upper(spark, sf):
    f, zero, one = F.col("p_retailprice"), F.lit(0.0), F.lit(1.0)
    k = table(spark, sf, "part").withColumn("k", cam.inverse_upper(F.array(f, F.lit(0.5), F.col("p_size").cast("double"), zero, f + 1, F.lit(3.0), zero, zero, one)))
    return k.select("p_partkey", *[F.round(F.get("k", F.lit(i)), 9).alias(n) for i, n in enumerate("abc")])


def pose_pairs(spark, sf):
    """All pairs of poses of a scene, a and b."""
    p = poses(spark, sf)
    a, b = (p.select("label", *[F.col(c).alias(f"{s}_{c}") for c in ("vec_id", "qx", "qy", "qz", "qw", "x", "y", "z", "m")]) for s in "ab")
    return a.join(b, "label").filter("a_vec_id < b_vec_id")


_PAIR = f"{_R} a JOIN {_R} b ON a.label = b.label AND a.vec_id < b.vec_id"


@query("I06_relative_pose", f"SELECT a.vec_id AS i, b.vec_id AS j, round(a.r00*b.r00 + a.r10*b.r10 + a.r20*b.r20, 6) AS r00, round(a.r01*(b.x-a.x) + a.r11*(b.y-a.y) + a.r21*(b.z-a.z), 6) AS ty FROM {_PAIR}")
def relative_pose(spark, sf):
    j = pose_pairs(spark, sf).withColumn("r", cam.relative_pose(F.col("a_m"), F.col("b_m")))
    return _rounded(j, [F.col("a_vec_id").alias("i"), F.col("b_vec_id").alias("j")], {"r00": cam.at(F.col("r"), 0, 0), "ty": cam.at(F.col("r"), 1, 3)})


@query("I07_centre", f"SELECT vec_id, round(-(r00*x + r10*y + r20*z), 6) AS cx, round(-(r01*x + r11*y + r21*z), 6) AS cy, round(-(r02*x + r12*y + r22*z), 6) AS cz, round(r20, 6) AS fx, round(r22, 6) AS fz FROM {_R}")
def centre(spark, sf):
    c, f = cam.centre(F.col("m")), cam.forward(F.col("m"))
    return _rounded(poses(spark, sf), ["vec_id"], {"cx": c[0], "cy": c[1], "cz": c[2], "fx": f[0], "fz": f[2]})


@query("I08_shift", f"SELECT vec_id, round(x + r00 + 2*r01 + 3*r02, 6) AS tx, round(z + r20 + 2*r21 + 3*r22, 6) AS tz FROM {_R}")
def shift(spark, sf):
    m = cam.shifted(F.col("m"), (F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    return _rounded(poses(spark, sf).withColumn("s", m), ["vec_id"], {"tx": cam.at(F.col("s"), 0, 3), "tz": cam.at(F.col("s"), 2, 3)})


@query("I09_axis_flip", f"SELECT vec_id, round(r00, 6) AS a, round(-r01, 6) AS b, round(-r22, 6) AS c, x AS t FROM {_R}")
def axis_flip(spark, sf):
    p = poses(spark, sf).withColumn("s", cam.flipped_axes(F.col("m")))
    return _rounded(p, ["vec_id"], {"a": cam.at(F.col("s"), 0, 0), "b": cam.at(F.col("s"), 0, 1), "c": cam.at(F.col("s"), 2, 2), "t": cam.at(F.col("s"), 0, 3)})


@query("I10_quaternion_to_rotation", f"SELECT vec_id, round(r00, 6) AS r00, round(r12, 6) AS r12, round(r20, 6) AS r20 FROM {_R}")
def quaternion_to_rotation(spark, sf):
    return _rounded(poses(spark, sf), ["vec_id"], {"r00": F.get("rot", F.lit(0)), "r12": F.get("rot", F.lit(5)), "r20": F.get("rot", F.lit(6))})


@query("I11_rotation_to_quaternion", f"SELECT vec_id, round(CASE WHEN qw < 0 THEN -qx ELSE qx END, 6) AS qx, round(CASE WHEN qw < 0 THEN -qy ELSE qy END, 6) AS qy, round(CASE WHEN qw < 0 THEN -qz ELSE qz END, 6) AS qz, round(abs(qw), 6) AS qw FROM {_Q}")
def rotation_to_quaternion(spark, sf):
    p = poses(spark, sf).select("vec_id", cam.rotation_to_quaternion(F.col("rot")).alias("q"))
    return _rounded(p, ["vec_id"], {n: F.get("q", F.lit(i)) for i, n in enumerate(("qx", "qy", "qz", "qw"))})


@query("I12_quaternion_relative", f"SELECT a.vec_id AS i, b.vec_id AS j, round(a.qw*b.qw + a.qx*b.qx + a.qy*b.qy + a.qz*b.qz, 6) AS w, round(a.qw*b.qx - a.qx*b.qw - a.qy*b.qz + a.qz*b.qy, 6) AS x FROM {_PAIR}")
def quaternion_relative(spark, sf):
    q = cam.quaternion_product(cam.quaternion_inverse(quat("a_")), quat("b_"))
    return _rounded(pose_pairs(spark, sf), [F.col("a_vec_id").alias("i"), F.col("b_vec_id").alias("j")], {"w": q[3], "x": q[0]})


@query("I13_slerp", f"""WITH p AS (SELECT a.vec_id i, b.vec_id j, a.qx ax, a.qw aw, sign(a.qx*b.qx + a.qy*b.qy + a.qz*b.qz + a.qw*b.qw) s, b.qx bx, b.qw bw, least(abs(a.qx*b.qx + a.qy*b.qy + a.qz*b.qz + a.qw*b.qw), 1.0) AS d FROM {_PAIR}), w AS (SELECT *, acos(d) AS o FROM p WHERE d <= 0.9995)
 SELECT i, j, round((sin(0.7*o) * ax + sin(0.3*o) * bx * s) / sin(o), 6) AS x, round((sin(0.7*o) * aw + sin(0.3*o) * bw * s) / sin(o), 6) AS w FROM w""")
def slerp(spark, sf):
    q = cam.slerp(quat("a_"), quat("b_"), F.lit(0.3))
    dot = sum((F.col(f"a_{c}") * F.col(f"b_{c}") for c in ("qy", "qz", "qw")), F.col("a_qx") * F.col("b_qx"))
    return _rounded(pose_pairs(spark, sf).filter(F.abs(dot) <= 0.9995), [F.col("a_vec_id").alias("i"), F.col("b_vec_id").alias("j")], {"x": q[0], "w": q[3]})


@query("I14_catmull_rom", f"""WITH s AS (SELECT label, vec_id, lag(x) OVER w AS p0, x AS p1, lead(x) OVER w AS p2, lead(x, 2) OVER w AS p3 FROM {_POINTS} WINDOW w AS (PARTITION BY label ORDER BY vec_id))
 SELECT label, vec_id, round(0.5 * (2*p1 + (p2 - p0) * 0.5 + (2*p0 - 5*p1 + 4*p2 - p3) * 0.25 + (3*p1 - p0 - 3*p2 + p3) * 0.125) + 1e-9, 5) AS x FROM s WHERE p0 IS NOT NULL AND p3 IS NOT NULL""")
def catmull_rom(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("label").orderBy("vec_id")
    s = centres(spark, sf).select("label", "vec_id", F.lag("x").over(w).alias("p0"), F.col("x").alias("p1"), F.lead("x").over(w).alias("p2"), F.lead("x", 2).over(w).alias("p3")).filter("p0 IS NOT NULL AND p3 IS NOT NULL")
    return s.select("label", "vec_id", F.round(cam.catmull_rom([F.col(f"p{i}") for i in range(4)], F.lit(1.5), [F.lit(float(i)) for i in range(4)]) + 1e-9, 5).alias("x"))


@query("I15_omega_phi_kappa", "SELECT vec_id, round(cos(radians(p)) * cos(radians(k)), 6) AS r00, round(cos(radians(o)) * sin(radians(k)) + sin(radians(o)) * sin(radians(p)) * cos(radians(k)), 6) AS r10, round(cos(radians(o)) * cos(radians(p)), 6) AS r22 FROM (SELECT vec_id, round(embedding[4]::DOUBLE * 90, 3) AS o, round(embedding[5]::DOUBLE * 90, 3) AS p, round(embedding[6]::DOUBLE * 180, 3) AS k FROM embeddings)")
def omega_phi_kappa(spark, sf):
    v = lambda i, s: F.round(F.element_at("embedding", i).cast("double") * s, 3)
    e = table(spark, sf, "embeddings").select("vec_id", cam.opk_rotation(v(4, 90), v(5, 90), v(6, 180)).alias("r"))
    return _rounded(e, ["vec_id"], {"r00": F.get("r", F.lit(0)), "r10": F.get("r", F.lit(3)), "r22": F.get("r", F.lit(8))})


@query("I16_resize_rotate", "SELECT p_partkey, round(p_retailprice * 0.25, 6) AS fx, round((p_size + 0.5::DOUBLE) * 0.25 - 0.5, 6) AS cx, 479.0::DOUBLE - p_size AS rot_cx FROM part")
def resize_rotate(spark, sf):
    s = F.col("p_size").cast("double")
    fx, cx = cam.resized_intrinsics(F.col("p_retailprice"), s, F.lit(0.25))
    rot = cam.rotated_intrinsics(F.col("p_retailprice"), F.col("p_retailprice"), F.lit(1.0), s, F.lit(640.0), F.lit(480.0), 1)
    return table(spark, sf, "part").select("p_partkey", F.round(fx, 6).alias("fx"), F.round(cx, 6).alias("cx"), rot[2].alias("rot_cx"))


@query("I17_resize_policy", "SELECT p_partkey, (floor(trunc(w * s) / 14) * 14)::INT AS w, (floor(trunc(h * s) / 14) * 14)::INT AS h FROM (SELECT p_partkey, w, h, least(1.0, 518.0::DOUBLE / greatest(w, h)) AS s FROM (SELECT p_partkey, 100 + p_size * 30 AS w, 2000 - p_size * 20 AS h FROM part))")
def resize_policy(spark, sf):
    w, h = cam.longest_side(100 + F.col("p_size") * 30, 2000 - F.col("p_size") * 20, 518, 14)
    return table(spark, sf, "part").select("p_partkey", w.alias("w"), h.alias("h"))


@query("I18_centred_crop", "SELECT p_partkey, floor(cx - mx)::INT AS l, floor(cy - my)::INT AS t, (floor(cx + mx) + 1)::INT AS r, (floor(cy + my) + 1)::INT AS b FROM (SELECT p_partkey, cx, cy, least(cx, 99 - cx) AS mx, least(cy, 79 - cy) AS my FROM (SELECT p_partkey, 20.25 + p_size AS cx, 70.5 - p_size AS cy FROM part))")
def centred_crop(spark, sf):
    box = cam.centred_crop(F.lit(100), F.lit(80), 20.25 + F.col("p_size"), 70.5 - F.col("p_size"))
    return table(spark, sf, "part").select("p_partkey", *[b.alias(n) for b, n in zip(box, "ltrb", strict=True)])


@query("I19_look_at", f"SELECT vec_id, round(y / sqrt(x*x + y*y), 6) + 0.0 AS rx, round(-x / sqrt(x*x + y*y), 6) + 0.0 AS ry, round(z / sqrt(x*x + y*y + z*z), 6) + 0.0 AS fz FROM {_POINTS} WHERE sqrt(x*x + y*y) > 1e-3")
def look_at(spark, sf):
    p = centres(spark, sf).filter(F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")) > 1e-3).withColumn("r", cam.look_at((F.col("x"), F.col("y"), F.col("z"))))
    return p.select("vec_id", *[(F.round(F.get("r", F.lit(i)), 6) + 0.0).alias(n) for n, i in (("rx", 0), ("ry", 1), ("fz", 8))])


@query("I19_yaw_pitch", "SELECT s_suppkey, round(cos(radians(s_nationkey)) * cos(radians(s_suppkey)), 6) AS x, round(cos(radians(s_nationkey)) * sin(radians(s_suppkey)), 6) AS y, round(sin(radians(s_nationkey)), 6) AS z FROM supplier")
def yaw_pitch(spark, sf):
    v = cam.yaw_pitch(F.col("s_suppkey"), F.col("s_nationkey"))
    return _rounded(table(spark, sf, "supplier"), ["s_suppkey"], dict(zip("xyz", v, strict=True)))


@query("K01_frustum_corners", "SELECT p_partkey, [round(0.5 * 320 / p_retailprice, 6), round(0.5 * 240 / p_retailprice, 6), 0.5] AS first, [round((1.0 + p_size) * 320 / p_retailprice, 6), round(-(1.0 + p_size) * 240 / p_retailprice, 6), 1.0 + p_size]::DOUBLE[] AS last FROM part")
def frustum_corners(spark, sf):
    f = F.col("p_retailprice")
    c = frustum.corners(f, f, F.lit(320.0), F.lit(240.0), F.lit(0.5), 1.0 + F.col("p_size"))
    r = lambda i: F.transform(F.get(c, F.lit(i)), lambda v: F.round(v, 6))
    return table(spark, sf, "part").select("p_partkey", r(0).alias("first"), r(7).alias("last"))


_BOX = f"(SELECT label AS scene, vec_id AS view, x * 4.0013::DOUBLE AS x, y * 4.0017::DOUBLE AS y, z * 4.0007::DOUBLE AS z FROM {_POINTS})"


def frustums(spark, sf):
    """Frustums along z from points: near 0.2, far 1, half-widths as deep as wide; scaled so that none just touch."""
    p = centres(spark, sf).select(F.col("label").alias("scene"), F.col("vec_id").alias("view"), *[(F.col(c) * k).alias(c) for c, k in zip("xyz", (4.0013, 4.0017, 4.0007), strict=True)])
    one = F.lit(1.0)
    c = frustum.corners(one, one, one, one, F.lit(0.2), one)
    moved = F.transform(c, lambda v: F.array(F.get(v, F.lit(0)) + F.col("x"), F.get(v, F.lit(1)) + F.col("y"), F.get(v, F.lit(2)) + F.col("z")))
    return p.withColumn("corners", moved)


@query("K02_frustum_faces", f"SELECT view, f::INT AS face, round(CASE f WHEN 0 THEN z + 0.2 ELSE z + 1.0 END, 6) AS depth FROM {_BOX}, range(0, 2) t(f)")
def frustum_faces(spark, sf):
    f = frustums(spark, sf).select("view", "corners", F.explode(F.array(F.lit(0), F.lit(1))).alias("face"))
    corner = F.get(F.col("corners"), F.when(F.col("face") == 0, frustum.PLANES[0][0]).otherwise(frustum.PLANES[1][0]))
    return f.select("view", "face", F.round(F.get(corner, F.lit(2)), 6).alias("depth"))


@query("K05_frustum_pairs", f"""WITH f AS {_BOX}, p AS (SELECT a.scene, a.view AS src, b.view AS dst, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy, a.z AS za, b.z AS zb FROM f a JOIN f b ON a.scene = b.scene AND a.view < b.view),
 q AS (SELECT *, greatest(za, zb) + 0.2 AS lo, least(za, zb) + 1.0 AS hi FROM p) SELECT scene, src, dst FROM q WHERE lo <= hi AND dx <= (hi - za) + (hi - zb) AND dy <= (hi - za) + (hi - zb)""")
def frustum_pairs(spark, sf):
    return frustum.meeting_pairs(frustums(spark, sf).select("scene", "view", "corners"))


@query("M01_rotation_error", f"SELECT a.vec_id AS i, b.vec_id AS j, round(degrees(2 * acos(least(1.0, abs(a.qx*b.qx + a.qy*b.qy + a.qz*b.qz + a.qw*b.qw)))), 4) AS err FROM {_PAIR}")
def rotation_error(spark, sf):
    j = pose_pairs(spark, sf)
    return j.select(F.col("a_vec_id").alias("i"), F.col("b_vec_id").alias("j"), F.round(cam.rotation_error(quat("a_"), quat("b_")), 4).alias("err"))


_DIR = "acos(greatest(-1.0, least(1.0, (a.x*b.x + a.y*b.y + a.z*b.z) / (sqrt(a.x*a.x + a.y*a.y + a.z*a.z) * sqrt(b.x*b.x + b.y*b.y + b.z*b.z)))))"


@query("M02_direction_error", f"SELECT a.vec_id AS i, b.vec_id AS j, round(least(degrees({_DIR}), 180 - degrees({_DIR})), 4) AS err FROM {_PAIR}")
def direction_error(spark, sf):
    v = lambda s: tuple(F.col(f"{s}_{c}") for c in "xyz")
    return pose_pairs(spark, sf).select(F.col("a_vec_id").alias("i"), F.col("b_vec_id").alias("j"), F.round(cam.direction_error(v("a"), v("b")), 4).alias("err"))


@query("M03_pairwise_summary", f"SELECT a.label, count(*) AS n, round(avg(degrees(2 * acos(least(1.0, abs(a.qx*b.qx + a.qy*b.qy + a.qz*b.qz + a.qw*b.qw))))), 4) AS rot, round(avg(least(degrees({_DIR}), 180 - degrees({_DIR}))), 4) AS dir FROM {_PAIR} GROUP BY 1")
def pairwise_summary(spark, sf):
    v = lambda s: tuple(F.col(f"{s}_{c}") for c in "xyz")
    return pose_pairs(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(cam.rotation_error(quat("a_"), quat("b_"))), 4).alias("rot"), F.round(F.avg(cam.direction_error(v("a"), v("b"))), 4).alias("dir"))


@query("M04_chord_angle", f"SELECT a.vec_id AS i, b.vec_id AS j, round(degrees(4 * asin(least(1.0, sqrt(power(a.qx-b.qx, 2) + power(a.qy-b.qy, 2) + power(a.qz-b.qz, 2) + power(a.qw-b.qw, 2)) / 2))), 4) AS deg FROM {_PAIR}")
def chord_angle(spark, sf):
    d2 = sum(((F.col(f"a_{c}") - F.col(f"b_{c}")) * (F.col(f"a_{c}") - F.col(f"b_{c}")) for c in ("qx", "qy", "qz", "qw")), F.lit(0.0))
    return pose_pairs(spark, sf).select(F.col("a_vec_id").alias("i"), F.col("b_vec_id").alias("j"), F.round(F.degrees(4 * F.asin(F.least(F.lit(1.0), F.sqrt(d2) / 2))), 4).alias("deg"))
