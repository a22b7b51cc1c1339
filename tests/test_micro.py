"""Hand-made cases whose results follow from the formulas, invariants, and malformed input."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orthoscape.functions import camera as cam
from orthoscape.functions import names
from orthoscape.functions.rng import uniform
from orthoscape.operators import aggregates, algebra, filters, joins, planning, raster, sequential, walks
from orthoscape.sources import binary, csr, text


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_field_of_view(spark):
    r = one(spark, a=cam.hfov(F.lit(1000.0), F.lit(500.0)), b=F.bround(F.lit(58.5), 0), c=F.bround(F.lit(59.5), 0))
    assert (round(r.a, 9), r.b, r.c) == (90.0, 58.0, 60.0)


@pytest.mark.parametrize("lo,hi,step", [(None, 3, 1), (-2, None, 1), (-2, 5, 1), (1, -1, 2), (4, 2, 1), (0, None, 3), (9, None, 1)])
def test_slices(spark, lo, hi, step):
    df = spark.createDataFrame([(f"s{i}",) for i in range(5)], "scene string")
    got = sorted(r[0] for r in filters.slice_rows(df, lo, hi, step).collect())
    assert got == [f"s{i}" for i in range(5)][lo:hi:step]


def test_ping_pong_and_resample(spark):
    assert one(spark, x=sequential.ping_pong(F.lit(4), F.lit(8))).x == [0, 1, 2, 3, 2, 1, 0, 1]
    assert one(spark, x=sequential.ping_pong(F.lit(1), F.lit(3))).x == [0, 0, 0]
    assert one(spark, x=sequential.resample_index(F.lit(2), 5, F.lit(4))).x == round(2 * 3 / 4)


def test_islands_with_a_cap(spark):
    df = spark.createDataFrame([(0, d) for d in (1, 2, 3, 5, 6)], "g int, d int")
    got = {r.d: r.island for r in sequential.islands(df, "d", ["g"], 2).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 5: 2, 6: 2}


def test_auc(spark):
    df = spark.createDataFrame([(0, e) for e in (0.5, 1.5, 2.5, 9.0)], "g int, e double")
    assert aggregates.auc_of_errors(df, ["g"], "e", 3).first().auc == pytest.approx(0.5)


def test_sliding_counts_windows(spark):
    df = spark.createDataFrame([(0, i, float(i)) for i in range(5)], "g int, i int, v double")
    got = [(r.k, r.w) for r in raster.sliding(df, ["g"], "i", "v", 3, 2).collect()]
    assert got == [(0, [0.0, 1.0, 2.0])]


def test_centre_shift_and_inverse(spark):
    m = F.array(*[F.lit(float(x)) for x in (1, 0, 0, 1, 0, 1, 0, 2, 0, 0, 1, 3, 0, 0, 0, 1)])
    c = cam.centre(m)
    s = cam.shifted(m, (F.lit(1.0), F.lit(1.0), F.lit(1.0)))
    i = cam.product(cam.inverse_rigid(m), m)
    r = one(spark, c=F.array(*c), t=F.array(*[cam.at(s, k, 3) for k in range(3)]), i=i)
    assert r.c == [-1, -2, -3] and r.t == [2, 3, 4] and r.i == np.eye(4).ravel().tolist()


def test_planning(spark):
    r = one(spark, s=planning.swath(F.lit(100.0), F.lit(90.0)), lane=planning.spacing(F.lit(100.0), F.lit(90.0), 0.8), n=planning.waypoint_estimate(F.lit(100.0), F.lit(4.0), 0.75))
    assert (round(r.s, 6), round(r.lane, 6), r.n) == (200.0, 40.0, 34)


def test_quaternion_round_trip(spark):
    rng = np.random.default_rng(0)
    q = rng.normal(size=(50, 4))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    q *= np.where(q[:, 3:] < 0, -1, 1)
    df = spark.createDataFrame(q.tolist(), "qx double, qy double, qz double, qw double")
    back = df.select("qx", "qy", "qz", "qw", cam.rotation_to_quaternion(cam.quaternion_to_rotation(tuple(F.col(c) for c in ("qx", "qy", "qz", "qw")))).alias("q"))
    for r in back.collect():
        assert np.allclose(r.q, [r.qx, r.qy, r.qz, r.qw], atol=1e-9)


def test_camera_text_round_trip_and_errors(spark):
    e = F.array(*[F.lit(float(x)) for x in (1, 0, 0, 5, 0, 1, 0, 6, 0, 0, 1, 7, 0, 0, 0, 1)])
    k = F.array(*[F.lit(float(x)) for x in (500, 0, 320, 0, 500, 240, 0, 0, 1)])
    good = text.format_camera(e, k, F.lit(480), F.lit(640), F.lit(65.2))
    r = one(spark, c=text.camera_file(good), bad=text.camera_file(F.lit("extrinsic\n1 2\n")), no=text.camera_file(F.lit("")), none=text.camera_file(F.lit(None).cast("string")), h=text.quick_hfov(good))
    assert r.c.ok and r.c.pose[3::4] == [-5, -6, -7, 1] and (r.c.h, r.c.w) == (480, 640) and r.h == round(math.degrees(2 * math.atan(640 / 1000)))
    assert not r.bad.ok and not r.no.ok and (r.none is None or not r.none.ok)


def test_names(spark):
    r = one(spark, s=names.stem(F.lit("a/b.c/img.01.JPG")), x=names.extension(F.lit("a/img.JPG")), m=names.matrix_shape(F.lit("v0--12x12.npy")), n=names.matrix_shape(F.lit("v0.npy")), f=names.float_list(F.lit("1 x")))
    assert (r.s, r.x, r.m, r.n, r.f) == ("img.01", ".jpg", [12, 12], None, None)


def test_csr(spark):
    e = spark.createDataFrame([("s", 0, 1, 0.4), ("s", 0, 2, 0.2), ("s", 2, 0, 0.6)], "scene string, src long, dst long, w double")
    r = csr.to_csr(e).first()
    assert list(r["indptr"]) == [0, 2, 2, 3] and list(r["indices"]) == [1, 2, 0]
    got = {(x.src, x.dst): round(x.w, 6) for x in joins.symmetric_max(e.select("src", "dst", "w")).collect()}
    assert got == {(0, 1): 0.4, (0, 2): 0.6, (2, 0): 0.6}


def test_csr_arrays_from_files(spark, tmp_path):
    d = tmp_path / "scene1"
    d.mkdir()
    np.save(d / "indptr.npy", np.array([0, 1, 1]))
    np.save(d / "indices.npy", np.array([1], np.int32))
    np.save(d / "data.npy", np.array([0.5], np.float16))
    (d / "meta.json").write_text("{}")
    assert [tuple(r) for r in csr.read_csr_arrays(spark, str(tmp_path)).collect()] == [("scene1", 0, 1, 0.5)]


def test_pfm_round_trip(spark, tmp_path):
    image = np.arange(12, dtype="f4").reshape(3, 4)
    assert (binary.parse_pfm(binary.format_pfm(image)) == image).all()
    (tmp_path / "a.pfm").write_bytes(binary.format_pfm(image))
    r = binary.read_rasters(spark, str(tmp_path)).first()
    assert (r["h"], r["w"], r["values"]) == (3, 4, image.ravel().tolist())
    with pytest.raises(ValueError):
        binary.parse_pfm(b"P6\n1 1\n1\nx")


def test_algebra(spark):
    df = spark.range(7).withColumnRenamed("id", "i")
    got = algebra.resized(df, 17, 1, "i").collect()
    assert len(got) == 17 and sorted(r.position for r in got) == list(range(17))
    assert all(sum(r.i == i for r in got) in (2, 3) for i in range(7))
    assert algebra.repeated(df, 3, "i").count() == 21


def test_walks_keep_their_rules():
    rng = np.random.default_rng(1)
    n = 30
    src, dst = zip(*[(a, b) for a in range(n) for b in range(n) if a != b], strict=True)
    g = walks.Graph(src, dst, rng.random(len(src)))
    for f in (walks.random_walk, walks.tree, walks.star):
        w = f(g, 8, np.random.default_rng(2), low=0.2, high=0.95, k=10)
        assert len(w) == len(set(w)) and len(w) > 1
    w = walks.chain(g, 8, 0, 0.2, 0.95, 10)
    assert all(g.weight(a, b) < 0.95 for i, a in enumerate(w) for b in w[:i])
    assert walks.farthest_points(np.array([[0, 0], [1, 0], [9, 0.0]]), np.tile([1.0, 0], (3, 1)), 2, 1.0) == [0, 2]


def test_uniform_is_in_range(spark):
    r = spark.range(2000).select(uniform(5, F.col("id")).alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= r[0] < 0.01 and 0.99 < r[1] < 1 and abs(r[2] - 0.5) < 0.03


def test_hulls_hold_all_points(spark):
    rng = np.random.default_rng(3)
    p = rng.normal(size=(300, 2))
    df = spark.createDataFrame([(1, *map(float, q)) for q in p], "g long, x double, y double")
    h = np.array([(r.x, r.y) for r in aggregates.convex_hulls(df, "g", "x", "y").orderBy("i").collect()])
    nxt = np.roll(h, -1, 0)
    side = (nxt[:, 0] - h[:, 0])[:, None] * (p[:, 1] - h[:, 1][:, None]) - (nxt[:, 1] - h[:, 1])[:, None] * (p[:, 0] - h[:, 0][:, None])
    assert (side > -1e-9).all()


def test_covisibility_counts_confirmed_pixels(spark):
    from orthoscape.plans.covisibility import depth_covisibility, strongest

    eye = [1.0, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1]
    cams = spark.createDataFrame([(0, v, 4.0, 4.0, 1.5, 1.5, 4, 4, [float(x) for x in eye], [float(x) for x in eye]) for v in (0, 1)], "scene int, view int, fx double, fy double, cx double, cy double, h int, w int, m array<double>, inv array<double>")
    pix = spark.createDataFrame([(0, v, r, c, 2.0 if v == 0 or c < 2 else 9.0) for v in (0, 1) for r in range(4) for c in range(4)], "scene int, view int, row int, col int, z double")
    pairs = spark.createDataFrame([(0, 0, 1), (0, 1, 0)], "scene int, src int, dst int")
    got = {(r.src, r.dst): r.w for r in depth_covisibility(pix, cams, pairs).collect()}
    assert got == {(0, 1): 0.5, (1, 0): 0.5}
    assert strongest(spark.createDataFrame([(0, 1, 0.5), (0, 2, 0.5), (0, 3, 0.1)], "src int, dst int, w double"), 1, 0.2).first().dst == 1


def test_public_split_rules(spark):
    from orthoscape.plans import splits

    scenes = [("blendedmvs", splits.BLENDEDMVS_NOISE[0]), ("blendedmvs", splits.BLENDEDMVS_VAL[0]), ("blendedmvs", "x"), ("ortholoc", "test_inPlace_1"), ("ortholoc", "other"), ("usegeo", "s"), ("whu_whuomvs", "whuomvs_1"), ("whu_whuomvs", "a"), ("uavscenes", splits.UAVSCENES_TRAIN[0]), ("uavscenes", "b"), ("unknown", "c")]
    got = sorted(tuple(r) for r in splits.splits_of(spark, spark.createDataFrame(scenes, "dataset string, scene string")).collect())
    want = [("blendedmvs", splits.BLENDEDMVS_VAL[0], "val"), ("blendedmvs", "x", "train"), ("ortholoc", "test_inPlace_1", "test"), ("uavscenes", splits.UAVSCENES_TRAIN[0], "train"), ("usegeo", "s", "test"), ("usegeo", "s", "val"), ("whu_whuomvs", "a", "train")]
    assert got == sorted(want)


def test_loader_settings():
    from orthoscape.plans.loader import config

    base = {"dataset": "d", "metric_scale": True, "synthetic": False}
    assert config(base, {"topk": 5, "low": None}).topk == 5
    with pytest.raises(ValueError):
        config(base, {"typo": 1})


def test_scene_metadata_keeps_one_backup(spark, tmp_path):
    from orthoscape.sources import catalog

    path = str(tmp_path / "scene_meta.json")
    for i in range(3):
        docs = catalog.scene_metadata(spark.createDataFrame([(1, "b", i), (1, "a", i)], "scene long, frame_name string, fx int"), ["scene"], "frame_name", ["fx"])
        catalog.store_metadata(docs, path)
    schema = docs.drop("frame_names").schema
    assert [f.fx for f in catalog.load_metadata(spark, path, schema).first().frames] == [2, 2]
    assert [f.fx for f in catalog.load_metadata(spark, path + "._backup", schema).first().frames] == [1, 1]
    assert catalog.load_metadata(spark, path, schema).first().frame_names == {"a": 0, "b": 1}


def test_equal_points_and_repeated_frames_count_each(spark):
    points = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, 99.0), (2, 5.0)], "g int, t double")
    chunks = spark.createDataFrame([(1, 7, 0.0, 10.0), (1, 8, 4.0, 6.0)], "g int, chunk int, s double, e double")
    got = joins.in_interval(points, chunks, ["g"], "t", "s", "e", "chunk", 10.0).collect()
    assert [(r.g, r.t, r.chunk) for r in got] == [(1, 5.0, 7)] * 2
    frames = spark.createDataFrame([(1, 0), (1, 0), (1, 1), (1, 3), (2, 0)], "frame_id int, position int")
    views = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "frame_id int, cam_id int")
    for policy, want in (("same", [(1, 10)] * 4 + [(2, 20)]), ("cycle", [(1, 10)] * 2 + [(1, 11)] * 2 + [(2, 20)]), ("all", [(1, 10)] * 4 + [(1, 11)] * 4 + [(2, 20)])):
        assert sorted((r.frame_id, r.cam_id) for r in joins.expand_views(frames, views, policy).collect()) == sorted(want)


@pytest.mark.parametrize("block", [2, 3, 256])
def test_shared_points_of_many_views(spark, monkeypatch, block):
    """Points that many views see give the same edges in blocks as in one row."""
    import collections
    import itertools
    import random

    from orthoscape.plans import covisibility

    monkeypatch.setattr(covisibility, "PAIR_BLOCK", block)
    rng = random.Random(1)
    seen = {(v, p) for p in range(12) for v in rng.sample(range(20), rng.choice([1, 2, 5, 20]))}
    rows = [*seen, *list(seen)[:30], (None, 3), (4, None)]
    got = {(r.src, r.dst): (r.shared, r.w) for r in covisibility.shared_point_edges(spark.createDataFrame(rows, "view int, point int"), "view", "point").collect()}
    size = collections.Counter(v for v, _ in seen)
    shared = collections.Counter((a, b) for p in range(12) for a, b in itertools.permutations([v for v, q in seen if q == p], 2))
    assert got == {e: (n, n / size[e[1]]) for e, n in shared.items()}


def test_candidates_lose_no_covisible_pair(spark):
    from orthoscape.plans.covisibility import depth_covisibility, overlapping_views

    rng = np.random.default_rng(4)
    cams, pix = [], []
    for v in range(30):
        c = rng.uniform(-25, 25, 3) if v else np.full(3, 500.0)
        m = np.eye(4)
        m[:3, 3] = c
        inv = np.eye(4)
        inv[:3, 3] = -c
        cams.append((v % 2, v, 5.0, 5.0, 1.0, 2.0, 4, 4, m.ravel().tolist(), inv.ravel().tolist()))
        pix += [(v % 2, v, r, k, float(z)) for (r, k), z in zip([(r, k) for r in range(4) for k in range(4)], rng.choice([0.0, math.nan, math.inf, 3.0, 8.0, 20.0], 16, p=[0.1, 0.02, 0.02, 0.2, 0.26, 0.4]), strict=True)]
    cams = spark.createDataFrame(cams, "scene int, view int, fx double, fy double, cx double, cy double, h int, w int, m array<double>, inv array<double>")
    pix = spark.createDataFrame(pix, "scene int, view int, row int, col int, z double")
    a, b = (cams.select("scene", F.col("view").alias(n)) for n in ("src", "dst"))
    every = a.join(b, "scene").filter("src <> dst")
    near = overlapping_views(pix, cams)
    assert 0 < near.count() < every.count()
    assert sorted(map(tuple, depth_covisibility(pix, cams).collect())) == sorted(map(tuple, depth_covisibility(pix, cams, every).collect())) != []


def test_frustums_meet_in_paired_blocks(spark, monkeypatch):
    """Every pair by quick tests as by crossing edges and faces, in any blocks, and no pair is shuffled."""
    from orthoscape.operators import blocks, frustum

    rng = np.random.default_rng(9)
    base = np.array([[sx * z, sy * z * 0.7, z] for z in (0.3, 2.0) for sx, sy in frustum.SIGNS])
    turn = np.linalg.qr(rng.normal(size=(90, 3, 3)))[0]
    c = base @ turn.transpose(0, 2, 1) + rng.uniform(-2.5, 2.5, (90, 1, 3)) + 1e5
    c[80:] = c[:10]  # the same place
    c[70:80] = base * rng.uniform(0.2, 3, (10, 1, 1)) + 1e5  # one in another
    i, j = np.divmod(np.arange(90 * 90), 90)
    want = frustum.frustums_meet(c[i] - 1e5, c[j] - 1e5).reshape(90, 90)
    off = ~np.eye(90, dtype=bool) & (i // 10 * 10 % 80 != j // 10 * 10 % 80).reshape(90, 90)
    assert 0.05 < want.mean() < 0.9 and (frustum.meeting(c, c) == want)[off].all()
    monkeypatch.setattr(blocks.in_paired_blocks, "__defaults__", (7,))
    rows = [(v % 3, v, c[v].tolist()) for v in range(70)] + [(0, 100, None), (None, 101, c[0].tolist()), (0, 102, c[0].tolist()[:7])]
    f = spark.createDataFrame(rows, "scene int, view long, corners array<array<double>>")
    out = frustum.meeting_pairs(f)
    got = out.collect()
    assert sorted(map(tuple, got)) == [(s, a, b) for s in range(3) for a in range(s, 70, 3) for b in range(a + 3, 70, 3) if want[a, b]]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan.split("\n")[0] or "MapInArrow" in plan.split("\n")[1]


@pytest.mark.parametrize("denominator", ["full", "target"])
def test_covisibility_in_paired_blocks(spark, monkeypatch, denominator):
    """Blocks of a few turned views of several sizes give what each pair gives by itself, and no pair is joined."""
    from orthoscape.plans import covisibility

    rng = np.random.default_rng(6)
    cams, pix = [], []
    for v in range(24):
        h, w = 3 + v % 3, 4 + v % 2
        m = np.eye(4)
        m[:3, :3] = np.linalg.qr(np.eye(3) + 0.2 * rng.normal(size=(3, 3)))[0]
        m[:3, :3] *= np.sign(np.diag(m[:3, :3]))
        m[:3, 3] = rng.uniform(-3, 3, 3)
        cams.append((v % 2, v, 5.0, 4.0, w / 2, h / 2, h, w, m.ravel().tolist(), np.linalg.inv(m).ravel().tolist()))
        pix += [(v % 2, v, r, k, float(z)) for (r, k), z in zip([(r, k) for r in range(h) for k in range(w)], rng.uniform(3, 9, h * w), strict=True) if (r + k + v) % 7]
    cams = spark.createDataFrame(cams, "scene int, view int, fx double, fy double, cx double, cy double, h int, w int, m array<double>, inv array<double>")
    pix = spark.createDataFrame(pix, "scene int, view int, row int, col int, z double")
    a, b = (cams.select("scene", F.col("view").alias(n)) for n in ("src", "dst"))
    how = {"absolute": 1.5, "temperature": 0.1, "denominator": denominator}
    want = sorted(map(tuple, covisibility.depth_covisibility(pix, cams, a.join(b, "scene").filter("src <> dst"), **how).collect()))
    monkeypatch.setattr(covisibility, "BLOCK_PIXELS", 60)
    monkeypatch.setattr(covisibility, "POINTS_AT_ONCE", 30)
    out = covisibility.depth_covisibility(pix, cams, **how)
    assert sorted(map(tuple, out.collect())) == want and len(want) > 50
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[0]


def strip_scene(rows=3, n=12):
    """Parallel strips of views on a grid; weights fall with distance."""
    at = {r * n + i: np.array([float(i), 1.5 * r, 0.0]) for r in range(rows) for i in range(n)}
    edges = [(a, b, math.exp(-float(np.linalg.norm(at[a] - at[b])))) for a in at for b in at if a != b and np.linalg.norm(at[a] - at[b]) < 3.2]
    return at, walks.Graph(*zip(*edges, strict=True)), {i: p[0] for i, p in at.items()}, {i: p[1] for i, p in at.items()}


def test_directed_chains_keep_their_rules():
    at, g, t, s = strip_scene()
    for start in (0, 5, 12, 30, None):
        w = walks.directed_chain(g, 6, np.random.default_rng(3), at, t, s, 0.1, start=start)
        steps = np.diff([t[i] for i in w])
        assert len(w) == len(set(w)) and (np.sign(steps) == np.sign(steps[0])).all()
        assert all(g.weight(a, b) >= 0.1 for a, b in zip(w, w[1:], strict=False))
        assert all(walks._turn(at[b] - at[a], at[c] - at[b]) <= 75 for a, b, c in zip(w, w[1:], w[2:], strict=False))
    # A start whose walk is short is tried again elsewhere, without the views walked before.
    lone = walks.Graph([0, 1, 5, 6, 7, 8], [1, 0, 6, 7, 8, 7], [0.9, 0.9, 0.9, 0.9, 0.9, 0.9])
    line = {i: np.array([float(i), 0.0, 0.0]) for i in range(9)}
    run = lambda seed, tries: walks.directed_chain(lone, 4, np.random.default_rng(seed), line, {i: float(i) for i in line}, dict.fromkeys(line, 0.0), 0.5, start=0, tries=tries)
    assert run(0, 1) == [0, 1] and [5, 6, 7, 8] in [run(seed, 9) for seed in range(20)]


def test_paired_strips_run_beside_the_first():
    at, g, t, s = strip_scene()
    first = list(range(12, 20))
    second = walks.paired_strip(g, first, t, s, 0.1, 0.2)
    assert len(second) >= 6 and not set(second) & set(first) and len({s[i] for i in second}) == 1
    assert all(b >= a for a, b in zip([t[i] for i in second], [t[i] for i in second[1:]], strict=False)) and all(g.weight(a, b) >= 0.2 for a, b in zip(second, second[1:], strict=False))
    assert walks.paired_strip(g, first, t, s, 2.0, 0.2) == [] and walks.paired_strip(g, first, t, s, 0.1, 0.2, gone=set(at)) == []
    both = walks.two_strips(g, 10, np.random.default_rng(2), at, 0.2, 0.1)
    assert len(both) == 10 and all(g.weight(a, b) >= 0.1 for a, b in zip(both[:5], both[5:], strict=True))


def test_walk_queries_equal_one_loop(spark):
    """Walks spread over tasks are those of one loop over the whole graph."""
    import functools
    import hashlib

    import oracle

    from orthoscape.queries import QUERIES
    from orthoscape.queries.joining import _KEPT

    sf = "/root/testdata/sf0.001"
    con = oracle.connect(sf)
    g = walks.Graph(*zip(*con.execute(f"SELECT src, dst, w FROM {_KEPT}").fetchall(), strict=True))
    views = [r[0] for r in con.execute("SELECT s_suppkey FROM supplier").fetchall()]
    for name, f in (("H08_star", walks.star), ("H09_random_walk", walks.random_walk), ("H11_tree", walks.tree)):
        f, want = functools.partial(f, low=0.2, high=0.4, k=20), []
        for v in views:
            state = int.from_bytes(hashlib.md5(f"7|0|{v}".encode()).digest()[:8], "big")
            want += [(0, v, i, x) for i, x in enumerate(f(g, 8, np.random.default_rng(state)))]
        assert sorted(tuple(r) for r in QUERIES[name](spark, sf).collect()) == sorted(want) != []


def test_strip_queries_equal_one_loop(spark):
    import oracle

    from orthoscape.queries import QUERIES
    from orthoscape.queries.joining import _POINTS

    sf, want = "/root/testdata/sf0.001", {"H13_directed_chain": [], "H14_paired_strip": [], "H15_two_strips": []}
    rows = oracle.connect(sf).execute(f"SELECT label, vec_id, x, y FROM {_POINTS}").fetchall()
    for scene in sorted({r[0] for r in rows}):
        at = {r[1]: np.array(r[2:]) for r in rows if r[0] == scene}
        w = {(a, b): math.exp(-3 * math.dist(at[a], at[b])) for a in at for b in at if a != b}
        g = walks.Graph(*zip(*[(a, b, x) for (a, b), x in w.items() if x >= 0.05], strict=True))
        t, s = ({i: float(p[j]) for i, p in at.items()} for j in (0, 1))
        rng = lambda: np.random.default_rng(scene)  # noqa: E731, B023
        one = walks.directed_chain(g, 6, rng(), at, t, s, 0.05, start=min(at))
        pair = walks.paired_strip(g, sorted(one, key=lambda i: t[i]), t, s, 0.3, 0.05)  # noqa: B023
        for name, views in (("H13_directed_chain", one), ("H14_paired_strip", pair), ("H15_two_strips", walks.two_strips(g, 10, rng(), at, 0.05, 0.3))):
            want[name] += [(scene, i, v) for i, v in enumerate(views)]
    for name, rows in want.items():
        assert sorted(tuple(r) for r in QUERIES[name](spark, sf).collect()) == sorted(rows) != []


def test_trajectory_error_equals_numpy(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(4):
        p = rng.normal(size=(30, 3))
        q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
        q *= np.sign(np.linalg.det(q))
        rows += [(g, *map(float, a), *map(float, b)) for a, b in zip(p, p @ q.T + 3 + 0.05 * g * rng.normal(size=(30, 3)), strict=True)]
    df = spark.createDataFrame(rows, "g long, x double, y double, z double, a double, b double, c double")
    got = {r.g: r.ate for r in aggregates.trajectory_error(df, "g", ("x", "y", "z"), ("a", "b", "c")).collect()}
    for g in range(4):
        d = np.array([r[1:] for r in rows if r[0] == g])
        gt, pr = d[:, :3], d[:, 3:]
        u, _, vt = np.linalg.svd((pr - pr.mean(0)).T @ (gt - gt.mean(0)))
        r = vt.T @ np.diag([1, 1, np.linalg.det(vt.T @ u.T)]) @ u.T
        want = np.linalg.norm((pr - pr.mean(0)) @ r.T + gt.mean(0) - gt, axis=1).mean()
        assert got[g] == pytest.approx(want, abs=1e-9) and (g or want < 1e-9)


def test_depth_cleaning_equals_loops(spark):
    """Q01 on all rasters, against numpy and plain loops."""
    import oracle

    from orthoscape.queries import QUERIES
    from orthoscape.queries.rasters import _P

    sf = "/root/testdata/sf0.001"
    images = {}
    for i, y, x, z in oracle.connect(sf).execute(f"SELECT vec_id, y, x, z FROM {_P}").fetchall():
        images.setdefault(i, np.zeros((8, 8)))[y, x] = z
    got = {r.vec_id: r for r in QUERIES["Q01_filter_depth"](spark, sf).collect()}
    assert set(got) == set(images)
    for i, z in images.items():
        low = z[z > 1e-6].min() + 0.1
        cut = np.where((z <= low) | (z <= 0), 0.0, z)
        p = np.pad(cut, 1, mode="reflect")
        gx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
        gy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
        grad = np.hypot(gx, gy)
        edge = grad > np.percentile(grad, 98) + 1e-12
        band = np.zeros((8, 8), bool)
        for y, x in zip(*np.nonzero(edge), strict=True):
            band[max(0, y - 1) : y + 2, max(0, x - 1) : x + 2] = True
        left = {(y, x) for y, x in zip(*np.nonzero((cut > 0) & ~band), strict=True)}
        valid = 0
        while left:
            part, todo = set(), [left.pop()]
            while todo:
                y, x = todo.pop()
                part.add((y, x))
                near = {(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & left
                left -= near
                todo += near
            valid += len(part) if len(part) >= 4 else 0
        r = got[i]
        assert (r.total_pixels, r.valid_before, r.threshold_removed, r.edge_pixels, r.band_pixels, r.valid_after) == (64, (z > 0).sum(), (z <= low).sum(), edge.sum(), band.sum(), valid)


def test_view_records_equal_loops(spark):
    """L01: the views of each sample with the means of their pixels."""
    import oracle

    from orthoscape.queries import QUERIES
    from orthoscape.queries.rasters import _P

    sf = "/root/testdata/sf0.001"
    con = oracle.connect(sf)
    views = {r[0] for r in con.execute("SELECT s_suppkey FROM supplier").fetchall()}
    mean = {r[0]: r[1:] for r in con.execute(f"SELECT vec_id, count(*), avg(z), avg((x - 3.5) * z / 6), avg((y - 3.5) * z / 6) FROM {_P} WHERE z > 0 GROUP BY 1").fetchall()}
    rows = QUERIES["L01_view_records"](spark, sf).collect()
    assert {r.sample for r in rows} == views and all(sorted(r.step for r in rows if r.sample == s) == list(range(6)) for s in views)
    for r in rows:
        n, z, x, y = mean[r.view]
        assert r.view in views and (r.n_valid, r.mean_depth, r.mx, r.my, r.mz) == (n, pytest.approx(z), pytest.approx(x), pytest.approx(y), pytest.approx(z))
        assert (r.dataset, r.is_metric_scale, r.is_synthetic) == ("stand-in", True, False)


def test_rectification_inverts_distortion(spark):
    k, p = (0.1, -0.02, 0.01), (0.003, -0.002)
    df = spark.createDataFrame([(i, j, i / 8 - 0.5, j / 8 - 0.5) for i in range(9) for j in range(9)], "a int, b int, u double, v double")
    dx, dy = raster.brown_distortion(F.col("u"), F.col("v"), k, p)
    for r in raster.rectified(df.withColumn("x", dx).withColumn("y", dy), "a", k, p).collect():
        assert (r.ux, r.uy) == (pytest.approx(r.u, abs=1e-7), pytest.approx(r.v, abs=1e-7))
    far = spark.createDataFrame([(0, 50.0, 50.0), (1, 0.0, 0.0)], "a int, x double, y double")
    assert [(r.ux is None, r.uy is None) for r in raster.rectified(far, "a", (-3.0, 0.0, 0.0), rounds=30).orderBy("a").collect()] == [(True, True), (False, False)]


def test_png_round_trip_and_filters(spark, tmp_path):
    import struct
    import zlib

    rng = np.random.default_rng(6)
    for shape, kind in (((5, 7), np.uint8), ((5, 7), np.uint16), ((4, 3, 3), np.uint8), ((3, 4, 2), np.uint8), ((6, 5, 4), np.uint16)):
        image = rng.integers(0, np.iinfo(kind).max, shape).astype(kind)
        assert (binary.parse_png(binary.format_png(image)) == image).all()

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    image = rng.integers(0, 256, (10, 6, 3)).astype(np.uint8)
    raw, lines = image.reshape(10, 18).astype(int), b""
    for y in range(10):  # every filter in turn, written as the format says
        kind = y % 5
        a = np.concatenate([[0] * 3, raw[y][:-3]])
        b = raw[y - 1] if y else np.zeros(18, int)
        c = np.concatenate([[0] * 3, b[:-3]])
        near = [min(((abs(q + r - s - q), 0, q), (abs(q + r - s - r), 1, r), (abs(q + r - s - s), 2, s)))[2] for q, r, s in zip(a, b, c, strict=True)]
        guess = [np.zeros(18, int), a, b, (a + b) // 2, np.array(near)][kind]
        lines += bytes([kind]) + ((raw[y] - guess) % 256).astype(np.uint8).tobytes()
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 6, 10, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)[:20]) + chunk(b"IDAT", zlib.compress(lines)[20:]) + chunk(b"IEND", b"")
    assert (binary.parse_png(data) == image).all()
    bits = chunk(b"IHDR", struct.pack(">IIBBBBB", 10, 1, 1, 3, 0, 0, 0)) + chunk(b"PLTE", bytes([0, 0, 0, 9, 8, 7])) + chunk(b"IDAT", zlib.compress(bytes([0, 0b10100000, 0b01000000])))
    assert binary.parse_png(b"\x89PNG\r\n\x1a\n" + bits)[0, :, 0].tolist() == [9, 0, 9, 0, 0, 0, 0, 0, 0, 9]
    (tmp_path / "a.png").write_bytes(binary.format_png(np.arange(12, dtype=np.uint16).reshape(3, 4) * 1000))
    r = binary.read_rasters(spark, str(tmp_path), "*.png").first()
    assert (r["h"], r["w"], r["values"]) == (3, 4, [1000.0 * i for i in range(12)])
    for bad in (b"", b"P6", data[:60], data.replace(b"IDAT", b"IDAX", 1), data[:20] + b"\xff" + data[21:]):
        with pytest.raises((ValueError, struct.error, zlib.error)):
            binary.parse_png(bad)


def test_settings_and_ranges():
    from orthoscape.functions import ranges
    from orthoscape.plans.loader import command_line, parsed_settings, settings

    checks = {"topk": ranges.positive_int, "share": ranges.ratio, "fovs": ranges.fields_of_view, "dry_run": ranges.boolean}
    assert command_line(["--topk=3", "--share", "0.5", "--fovs", "60,40,60", "--dry-run"], checks) == {"topk": 3, "share": 0.5, "fovs": [40.0, 60.0], "dry_run": True}
    assert command_line(["--no-dry-run"], checks) == {"dry_run": False}
    assert settings({"topk": 1, "share": 0.1}, "share: 0.2\ntopk: 2", ["--topk", "3"], checks) == {"topk": 3, "share": 0.2}
    assert parsed_settings("") == {} == parsed_settings("{}")
    for words in (["--topk", "0"], ["--topk", "1.5"], ["--share=1.1"], ["--share", "nan"], ["--fovs", ","], ["--fovs", "0"], ["--fovs", "179"], ["--other", "1"], ["topk"], ["--topk"], ["--dry-run", "maybe"]):
        with pytest.raises(ValueError):
            command_line(words, checks)
    with pytest.raises(ValueError):
        parsed_settings("- 1")
    for f, good, bad in ((ranges.nonnegative_int, "0", "-1"), (ranges.positive_float, "0.1", "inf"), (ranges.field_of_view, "178.9", "-3")):
        assert f(good) == float(good)
        with pytest.raises(ValueError):
            f(bad)


def test_pruning_holds_over_batches(spark):
    """The last kept row is carried from batch to batch, and groups don't mix."""
    rng = np.random.default_rng(8)
    rows = [(g, i, *map(float, rng.normal(scale=0.4, size=2)), float(rng.integers(0, 360))) for g in ("a", "b", None) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, i long, x double, y double, a double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    got = sorted((str(r.g), r.i) for r in sequential.greedy_prune(df.repartition(5), ["g"], "i", ["x", "y"], "a", 0.9, 120).collect())
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, last = [], {}
    for g, i, x, y, a in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        if g in last:
            turn = abs(a - last[g][2]) % 360
            if not (math.dist((x, y), last[g][:2]) > 0.9 or min(turn, 360 - turn) > 120):
                continue
        last[g] = (x, y, a)
        want.append((str(g), i))
    assert got == sorted(want)


def test_csr_of_many_views(spark):
    import time

    n = 20_000
    e = spark.range(n).select(F.lit("s").alias("scene"), F.col("id").alias("src"), ((F.col("id") * 7 + 1) % n).alias("dst"), F.lit(0.5).alias("w")).filter("src % 3 = 0 AND src <> dst")
    began = time.time()
    r = csr.to_csr(e).first()
    assert time.time() - began < 15 and len(r["indptr"]) == r["shape"][0] + 1 and r["indptr"][-1] == len(r["indices"]) == e.count()


@pytest.mark.parametrize("at_once", [100_000, 3])
def test_split_lookups_are_never_broadcast(spark, monkeypatch, at_once):
    """However small the table of scenes looks, each has many lookups; repeated scenes count as often as they come."""
    monkeypatch.setattr(filters, "RULES_AT_ONCE", at_once)
    rules = spark.createDataFrame([("d", 0, "name", "ab", ["x"]), ("d", 1, "prefix", "a", ["y", "z"]), ("d", 2, "prefix", "", []), ("e", 0, "all", "ignored", ["w"])], "dataset string, rule_order int, kind string, pattern string, splits array<string>")
    scenes = spark.createDataFrame(pa.table({"dataset": ["d", "d", "d", "e", "d"], "scene": ["ab", "abc", "b", "q", "abc"]}))
    got = filters.assign_splits(scenes, rules, repeats=True)
    want = [("d", "ab", "x"), *[("d", "abc", "y")] * 2, *[("d", "abc", "z")] * 2, ("e", "q", "w")]
    assert sorted(map(tuple, got.collect())) == want and sorted(map(tuple, filters.assign_splits(scenes, rules).collect())) == sorted(set(want))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and ("SortMergeJoin" in plan) == (at_once == 3)


def test_many_datasets_and_rules(spark):
    sizes = spark.range(12_000).select(F.format_string("d%06d", "id").alias("dataset"), (F.col("id") % 3).alias("size"))
    q = spark.createDataFrame([(0,), (1,), (2,), (11_999,), (12_000,), (-1,)], "index long")
    got = sorted((r["index"], r.dataset, r.local) for r in algebra.locate(q, sizes).collect())
    want, start = [], 0
    for i in range(12_000):
        want += [(x, f"d{i:06d}", x - start) for x in (0, 1, 2, 11_999) if start <= x < start + i % 3]
        start += i % 3
    assert got == sorted(want)
    rules = spark.createDataFrame([("d", 0, "name", "ab", ["x"]), ("d", 1, "prefix", "a", ["y", "z"]), ("d", 2, "prefix", "", []), ("e", 0, "all", "ignored", ["w"]), ("e", 1, "name", "q", ["v"])], "dataset string, rule_order int, kind string, pattern string, splits array<string>")
    scenes = spark.createDataFrame([("d", "ab"), ("d", "abc"), ("d", "b"), ("e", "q"), ("f", "q"), ("d", "abc")], "dataset string, scene string")
    assert sorted(tuple(r) for r in filters.assign_splits(scenes, rules).collect()) == [("d", "ab", "x"), ("d", "abc", "y"), ("d", "abc", "z"), ("e", "q", "w")]


def test_rules_of_sets_by_name(spark):
    from orthoscape.plans import splits

    scenes = spark.createDataFrame([("r", splits.REAL_TEST_PREFIXES[0] + "1"), ("r", "x"), ("t", splits.AMBIGUITY_TEST[0]), ("t", "x")], "dataset string, scene string")
    got = sorted(tuple(r) for r in splits.splits_of(spark, scenes, splits.real_rules("r") + splits.ambiguity_rules("t")).collect())
    assert got == sorted([("r", splits.REAL_TEST_PREFIXES[0] + "1", "test"), ("r", splits.REAL_TEST_PREFIXES[0] + "1", "val"), ("r", "x", "train"), ("t", splits.AMBIGUITY_TEST[0], "test")])


def test_walks_on_rows_of_views_are_those_on_whole_scenes(spark):
    import functools

    rng = np.random.default_rng(5)
    edges = spark.createDataFrame([(s, 3 * a, 3 * b, float(rng.random())) for s in (1, 2) for a in range(14) for b in range(14) if a != b and rng.random() < 0.4], "scene long, src long, dst long, w double")
    samples = spark.createDataFrame([(s, i) for s in (1, 2, 3) for i in (0, 3, 4, 9)] + [(1, 9)], "scene long, sample long")

    def chain(g, n, rng, sample):
        return walks.chain(g, n, sample, 0.2, 0.7, 5)

    for f, own in ((chain, True), (functools.partial(walks.random_walk, low=0.2, high=0.7, k=5), False), (functools.partial(walks.tree, low=0.2, high=0.7, k=5), False)):
        whole, paged = (sorted(map(tuple, walks.sample_walks(edges, samples, f, 5, 1, own, 0.2, copied).collect())) for copied in (10**6, 0))
        assert whole == paged and len({r[3] for r in paged}) > 3


def test_points_make_their_own_edges():
    rng = np.random.default_rng(6)
    ids, at = rng.permutation(60) * 2, np.round(rng.random((60, 2)) * 6, 2)
    near = [(a, b, math.exp(-3 * math.sqrt((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2))) for a, p in zip(ids, at, strict=True) for b, q in zip(ids, at, strict=True) if a != b and (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= 0.49]
    whole, lazy = walks.Graph(*zip(*near, strict=True)), walks.PointGraph(ids, at[:, 0], at[:, 1], 3, 0.7)
    assert lazy.nodes == whole.nodes and len(whole.nodes) < 60
    assert all(lazy.row(a) == pytest.approx(whole.row(a)) and lazy.weight(a, b) == pytest.approx(whole.weight(a, b)) for a in range(121) for b in range(121))


def test_points_of_many_views_and_of_many_batches(spark):
    import collections
    import itertools

    from orthoscape.plans import covisibility

    rows = [(v, p) for p in range(40) for v in range(7 * (p % 3), 7 * (p % 3) + (600 if p == 5 else 9))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.src, r.dst): r.shared for r in covisibility.shared_point_edges(spark.createDataFrame(rows, "view long, point string"), "view", "point").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = collections.defaultdict(list)
    for v, p in rows:
        seen[p].append(v)
    assert got == collections.Counter(e for vs in seen.values() for e in itertools.permutations(vs, 2))
