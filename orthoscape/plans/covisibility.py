"""View graphs: scores of pairs of views, cut to the strongest edges of each."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.blocks import BLOCK, in_paired_blocks
from ..operators.frustum import touching_spheres


def strongest(edges: DataFrame, k: int, least: float, by: list[str] | None = None) -> DataFrame:
    """The k strongest edges of each source with at least the least weight, and their rank; ties to the smaller dst."""
    w = Window.partitionBy(*(by or []), "src").orderBy(F.desc("w"), F.col("dst"))
    return edges.filter(F.col("w") >= least).withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


PAIR_BLOCK = 256
#: Pairs of views that a task counts at a time.
PAIRS_AT_ONCE = 1 << 22


def _point_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(left, right, point) rows of (view, size) lists from rows (point, view, size) in the order of points and views."""

    def lists(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        point, view, size = (t.column(i).chunk(0) for i in range(3))
        begin = np.concatenate([[0], np.flatnonzero(pc.not_equal(point[1:], point[:-1]).to_numpy(zero_copy_only=False)) + 1])
        many = np.diff(np.append(begin, len(t)))
        each = pa.StructArray.from_arrays([view, size], ["v", "n"])
        small = pa.array((many > 1) & (many <= PAIR_BLOCK))
        left = pa.ListArray.from_arrays(pa.array(np.append(begin, len(t)), pa.int32()), each).filter(small)
        left, right, of = [left], [pa.nulls(len(left), left.type)], [point.take(pa.array(begin)).filter(small)]
        for g in np.flatnonzero(many > PAIR_BLOCK).tolist():
            cuts = [(x, min(x + PAIR_BLOCK, begin[g] + many[g])) for x in range(begin[g], begin[g] + many[g], PAIR_BLOCK)]
            one = [pa.ListArray.from_arrays(pa.array([0, y - x], pa.int32()), each[x:y]) for x, y in cuts]
            for i, first in enumerate(one):
                left += [first] * (len(one) - i)
                right += [pa.nulls(1, first.type), *one[i + 1 :]]
                of += [point[begin[g] : begin[g] + 1]] * (len(one) - i)
        return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in (left, right, of)], ["left", "right", "p"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        points = batch.column(0)
        last = pc.index(points, points[-1]).as_py()
        if held and not (last == 0 and points[0] == held[-1].column(0)[0]):
            before = [*held, batch.slice(0, last)]
            held = []
            yield lists(pa.Table.from_batches(before))
        elif not held and last:
            yield lists(pa.Table.from_batches([batch.slice(0, last)]))
        held.append(batch.slice(last))
    if held:
        yield lists(pa.Table.from_batches(held))


def _pairs_of(left: pa.Array, right: pa.Array) -> Iterator[pa.RecordBatch]:
    own = left.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    other = pc.fill_null(right.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    (lv, ln), (rv, rn) = ([x.to_numpy(zero_copy_only=False) for x in side.flatten().flatten()] for side in (left, right))
    views, code = np.unique(np.concatenate([lv, rv]), return_inverse=True)
    size = np.zeros(len(views), np.int64)
    size[code] = np.concatenate([ln, rn])
    # Each view of left meets those after it in left, or all of right, which follows left in code.
    at, alone = np.arange(len(lv)), np.repeat(right.is_null().to_numpy(zero_copy_only=False), own)
    many = np.where(alone, np.repeat(np.cumsum(own), own) - at - 1, np.repeat(other, own))
    begin = np.where(alone, at + 1, len(lv) + np.repeat(np.cumsum(other) - other, own))
    upto, lo = np.cumsum(many), 0
    dense = np.zeros(len(views) ** 2, np.int64) if len(views) ** 2 <= 2 * PAIRS_AT_ONCE else None

    def rows(pair: np.ndarray, shared: np.ndarray) -> pa.RecordBatch:
        x, y = np.divmod(pair, max(1, len(views)))
        x, y = np.concatenate([x, y]), np.concatenate([y, x])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (views[x], views[y], np.tile(shared, 2).astype(np.int64), size[x], size[y])], ["src", "dst", "shared", "n_src", "n_dst"])

    while lo < len(lv):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS_AT_ONCE, "right")))
        m = many[lo:hi]
        second = np.arange(m.sum()) + np.repeat(begin[lo:hi] - (np.cumsum(m) - m), m)
        pair = np.repeat(code[lo:hi] * len(views), m) + code[second]
        if dense is None:
            yield rows(*np.unique(pair, return_counts=True))
        else:
            dense += np.bincount(pair, minlength=len(dense))
        lo = hi
    if dense is not None:
        pair = np.flatnonzero(dense)
        yield rows(pair, dense[pair])


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(src, dst, shared, n_src, n_dst), both ways, of rows (left, right) of (view, size) lists; right is null for the pairs of left."""
    held, total = [], 0

    def together() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        return _pairs_of(t.column(0).chunk(0), t.column(1).chunk(0))

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            sizes = [pc.fill_null(batch.column(i).value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1)]
            total += int((sizes[0] * np.where(sizes[1] > 0, sizes[1], sizes[0] / 2)).sum())
        if total > 4 * PAIRS_AT_ONCE:
            yield from together()
            held, total = [], 0
    if held:
        yield from together()


def shared_point_edges(observations: DataFrame, view: str, point: str, denominator: str = "target") -> DataFrame:
    """Directed edges between views by the points they share.

    observations: view, point (repeats count once).  Views get their size while
    they are gathered, so no edge is shuffled for it.  A point's views are one
    row; rows that begin with the same views go to the same task, so that the
    pairs of a part of the graph are counted together before any pair is
    shuffled, and a pair is shuffled by its source only.  A point that many
    views see is dealt in pairs of blocks of ``PAIR_BLOCK`` views, each a row
    of its own that any task can take.
    """
    kind, of = (observations.schema[c].dataType.simpleString() for c in (view, point))
    seen = observations.select(F.col(view).alias("v"), F.col(point).alias("p")).filter("v IS NOT NULL AND p IS NOT NULL").repartition("v").distinct()
    sized = seen.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("v")))
    each = f"array<struct<v:{kind},n:bigint>>"
    dealt = sized.select("p", "v", "n").repartition("p").sortWithinPartitions("p", "v").mapInArrow(_point_lists, f"left {each}, right {each}, p {of}")
    near = dealt.repartitionByRange(F.get("left", F.lit(0))["v"], F.get("left", F.lit(1))["v"], F.get("right", F.lit(0))["v"], "p").sortWithinPartitions(F.get("left", F.lit(0))["v"])
    pairs = near.select("left", "right").mapInArrow(_pair_counts, f"src {kind}, dst {kind}, shared long, n_src long, n_dst long")
    over = "n_dst" if denominator == "target" else "n_src"
    edges = pairs.select("src", "dst", "shared", F.col(over).alias("n")).repartition("src").groupBy("src", "dst").agg(F.sum("shared").alias("shared"), F.max("n").alias("n"))
    return edges.select("src", "dst", "shared", (F.col("shared") / F.greatest("n", F.lit(1))).alias("w"))


def projected(point: tuple[Column, Column, Column], world_to_cam: list[Column], fx: Column, fy: Column, cx: Column, cy: Column) -> tuple[Column, Column, Column]:
    """(row, col, depth) of a world point in a camera; depth is clamped away from 0 in the division only."""
    m = world_to_cam
    x, y, z = (m[4 * i] * point[0] + m[4 * i + 1] * point[1] + m[4 * i + 2] * point[2] + m[4 * i + 3] for i in range(3))
    safe = F.greatest(F.abs(z), F.lit(1e-5))
    return fy * y / safe + cy, fx * x / safe + cx, z


def _spheres(top: DataFrame, absolute: float, relative: float) -> DataFrame:
    """top (a camera's columns and z, its largest depth) with the sphere (x, y, z, r) that holds a view's points and its
    frustum up to the largest depth that its pixels can confirm."""
    reach = (F.col("z") + absolute) / (1 - relative)
    side = lambda c, n: F.greatest(F.abs(-1 - F.col(c)), F.abs(F.col(n) + 1 - F.col(c))) / F.col(f"f{c[1]}")
    wide = F.sqrt(side("cx", "w") * side("cx", "w") + side("cy", "h") * side("cy", "h") + 1)
    m = [F.get("m", F.lit(i)) for i in (3, 7, 11)]
    return top.withColumns({"r": reach * wide, **dict(zip("xyz", m, strict=True))})


def overlapping_views(pixels: DataFrame, cameras: DataFrame, absolute: float = 0.2, relative: float = 0.02) -> DataFrame:
    """Ordered candidate pairs (scene, src, dst): all of which any pixel of src can be confirmed in dst.

    A view's sphere holds its points and its frustum up to the largest depth
    that its pixels can confirm.  Views whose spheres don't touch share
    nothing; the others meet by grid cells as wide as their scene's largest sphere.
    """
    seen = F.when((F.col("z") > 0) & ~F.isnan("z") & (F.col("z") != float("inf")), F.col("z")).otherwise(0.0)
    top = pixels.groupBy("scene", "view").agg(F.max(seen).alias("z"))
    spheres = _spheres(cameras.join(top, ["scene", "view"]), absolute, relative).select("scene", "view", "x", "y", "z", "r")
    cells = spheres.groupBy("scene").agg((2 * F.max("r")).alias("cell"))
    near = touching_spheres(spheres.join(cells, "scene"), "scene", F.col("cell"))
    return near.unionByName(near.select("scene", F.col("dst").alias("src"), F.col("src").alias("dst")))


#: Pixels of a block of views, and points that are projected at a time.
BLOCK_PIXELS, POINTS_AT_ONCE = 1 << 19, 1 << 15


def _pixels(t: pa.Table) -> tuple[np.ndarray, ...]:
    """row, col and z of the pixels of the views of t, one after the other, and how many each view has."""
    held = [t.column(c).chunk(0) for c in ("rows", "cols", "zs")]
    return *[x.flatten().to_numpy(zero_copy_only=False) for x in held], held[0].value_lengths().to_numpy(zero_copy_only=False)


def _world(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """World points (3, n) of the valid pixels of the views of t, in their order, and the views' places of theirs."""
    row, col, z, many = _pixels(t)
    of = np.repeat(np.arange(len(many)), many)
    ok = (z > 0) & np.isfinite(z)
    row, col, z, of = row[ok], col[ok], z[ok], of[ok]
    fx, fy, cx, cy = (t.column(c).to_numpy()[of] for c in ("fx", "fy", "cx", "cy"))
    m = t.column("m").chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, 16)[of].T
    x, y = (col - cx) * z / fx, (row - cy) * z / fy
    return np.stack([m[4 * i] * x + m[4 * i + 1] * y + m[4 * i + 2] * z + m[4 * i + 3] for i in range(3)]), of


def _line(m: np.ndarray, p: np.ndarray) -> np.ndarray:
    """A row of a matrix times points, in the order of projected(); terms of 0 are left out, which changes no finite sum."""
    out = None
    for k, v in enumerate(m[:3].tolist()):
        if v:
            term = p[k] if v == 1 else v * p[k]
            out = term if out is None else out + term
    return np.full(p.shape[1], m[3]) if out is None else out + m[3] if m[3] else out


def _confirmed(absolute: float, relative: float, least: float, temperature: float):
    """(scene, src, dst, hits) of two blocks of views: how many points of src the raster of dst confirms."""

    def hits_of(left: pa.Table, right: pa.Table, near: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        points, of = _world(left)
        cuts = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(left)))])
        parts, lo = [], 0
        while lo < len(left):
            hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + POINTS_AT_ONCE, "right")) - 1)
            parts.append((lo, hi, np.ascontiguousarray(points[:, cuts[lo] : cuts[hi]]), of[cuts[lo] : cuts[hi]] - lo))
            lo = hi
        row, col, z, many = _pixels(right)
        begin = np.concatenate([[0], np.cumsum(many)])
        fx, fy, cx, cy, h, w = (right.column(c).to_numpy() for c in ("fx", "fy", "cx", "cy", "h", "w"))
        inv = right.column("inv").chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, 16)
        for j in range(len(right)):
            a, b = begin[j], begin[j + 1]
            held = (row[a:b] >= 0) & (row[a:b] < h[j]) & (col[a:b] >= 0) & (col[a:b] < w[j])
            raster = np.full(h[j] * w[j], np.nan)
            raster[row[a:b][held] * w[j] + col[a:b][held]] = z[a:b][held]
            for lo, hi, p, own in parts:
                touch = near[lo:hi, j]
                if not touch.any():
                    continue
                if 2 * np.count_nonzero(touch) < len(touch):
                    take = touch[own]
                    p, own = p[:, take], own[take]
                d = _line(inv[j, 8:12], p)
                safe = np.maximum(np.abs(d), 1e-5)
                pr = fy[j] * _line(inv[j, 4:8], p) / safe + cy[j]
                pc_ = fx[j] * _line(inv[j, :4], p) / safe + cx[j]
                at = np.flatnonzero((pr >= 0) & (pr < h[j]) & (pc_ >= 0) & (pc_ < w[j]) & (d > least))
                d = d[at]
                r, c = (np.minimum(np.rint(x[at]).astype(np.int64), n - 1) for x, n in ((pr, h[j]), (pc_, w[j])))
                limit = absolute + relative * d - math.log(0.5) * temperature
                hit = at[np.abs(d - raster[r * w[j] + c]) < limit]
                hits = np.bincount(own[hit], minlength=hi - lo)
                hits[~touch] = 0
                i = np.flatnonzero(hits)
                yield i + lo, np.full(len(i), j), hits[i]

    def compare(left: pa.Table, right: pa.Table, same: bool) -> Iterator[pa.RecordBatch]:
        scene = left.column("scene")[0]
        (ax, ar), (bx, br) = ((np.stack([t.column(c).to_numpy() for c in "xyz"], 1), t.column("r").to_numpy()) for t in (left, right))
        d2, reach = sum((ax[:, None, k] - bx[None, :, k]) ** 2 for k in range(3)), ar[:, None] + br[None]
        near = d2 <= reach * reach * (1 + 1e-9)
        for src, dst, touch in ((left, right, near),) if same else ((left, right, near), (right, left, near.T)):
            held, many = [], 0
            for found in hits_of(src, dst, touch):
                held.append(found)
                many += len(found[0])
                if many >= 1 << 16:
                    yield rows(scene, src, dst, held)
                    held, many = [], 0
            if held:
                yield rows(scene, src, dst, held)

    def rows(scene: pa.Scalar, src: pa.Table, dst: pa.Table, held: list) -> pa.RecordBatch:
        i, j, hits = (np.concatenate(x) for x in zip(*held, strict=True))
        of = [t.column("view").chunk(0).take(pa.array(x)) for t, x in ((src, i), (dst, j))]
        n = [t.column(c).chunk(0).take(pa.array(x)) for t, x, c in ((src, i, "area"), (dst, j, "valid"))]
        batch = pa.RecordBatch.from_arrays([pa.repeat(scene, len(i)), *of, pa.array(hits.astype(np.int64)), *n], ["scene", "src", "dst", "hits", "area", "valid"])
        return batch.filter(pc.not_equal(of[0], of[1]))

    return compare


def _all_hits(pixels: DataFrame, cameras: DataFrame, absolute: float, relative: float, temperature: float, min_depth: float) -> DataFrame:
    """(scene, src, dst, hits, area, valid) of all pairs of views with a hit; a view's pixels are one row, sent once a pair of blocks."""
    one = F.struct(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col("z").cast("double").alias("z"))
    seen = F.when((F.col("z") > 0) & ~F.isnan("z") & (F.col("z") != float("inf")), F.col("z")).otherwise(0.0)
    views = pixels.filter("z IS NOT NULL").groupBy("scene", "view").agg(F.collect_list(one).alias("pixels"), F.max(seen).alias("z"), F.count_if(F.col("z") > 0).alias("valid"))
    doubles = [F.col(c).cast("double").alias(c) for c in ("fx", "fy", "cx", "cy")]
    cams = cameras.select("scene", "view", *doubles, F.col("h").cast("long").alias("h"), F.col("w").cast("long").alias("w"), F.col("m").cast("array<double>").alias("m"), F.col("inv").cast("array<double>").alias("inv"))
    spheres = _spheres(cams.join(views, ["scene", "view"]), absolute - math.log(0.5) * temperature, relative).withColumn("area", F.col("h") * F.col("w"))
    box = [(F.col(c) + s * F.col("r")).alias(f"{c}{n}") for n, s in ((0, -1), (1, 1)) for c in "xyz"]
    largest = cams.agg(F.max(F.col("h") * F.col("w"))).first()[0] or 1
    kind = cameras.schema
    names = [kind[c].dataType.simpleString() for c in ("scene", "view")]
    schema = f"scene {names[0]}, src {names[1]}, dst {names[1]}, hits long, area long, valid long"
    size = min(BLOCK, max(1, BLOCK_PIXELS // largest))
    rows = spheres.select("*", *[F.col(f"pixels.{c}").alias(f"{c}s") for c in ("row", "col", "z")], *box).drop("pixels")
    return in_paired_blocks(rows, "scene", "view", _confirmed(absolute, relative, min_depth, temperature), schema, size)


def depth_covisibility(pixels: DataFrame, cameras: DataFrame, pairs: DataFrame | None = None, absolute: float = 0.2, relative: float = 0.02, temperature: float = 0.0, min_depth: float = 0.04, denominator: str = "full") -> DataFrame:
    """Edges (scene, src, dst, w): the share of src's pixels whose depth dst confirms.

    pixels: scene, view, row, col, z.  cameras: scene, view, fx, fy, cx, cy, h,
    w, m (camera to world, row by row) and inv (its inverse).  pairs: scene,
    src, dst candidates; without them, those whose spheres touch (overlapping_views).  A view's
    pixels are gathered once, as an array of one row.  Without pairs, views meet
    in pairs of blocks and no pair is shuffled.  With them, a pair's row has the
    points of src and the raster of dst, which are exploded, projected and
    looked up in place, and a pair's count leaves its task as one row.
    """
    if pairs is None:
        hits = _all_hits(pixels, cameras, absolute, relative, temperature, min_depth)
        share = F.col("hits") / F.col("area") if denominator == "full" else F.least(F.lit(1.0), F.col("hits") / F.greatest("valid", F.lit(1)))
        return hits.select("scene", "src", "dst", share.alias("w"))
    a = cameras.select("scene", F.col("view").alias("src"), *[F.col(c).alias(f"a_{c}") for c in ("fx", "fy", "cx", "cy", "m")])
    finite = (F.col("z") > 0) & ~F.isnan("z") & (F.col("z") != float("inf"))
    own = pixels.filter(finite).withColumnRenamed("view", "src").join(a, ["scene", "src"])
    cam = ((F.col("col") - F.col("a_cx")) * F.col("z") / F.col("a_fx"), (F.col("row") - F.col("a_cy")) * F.col("z") / F.col("a_fy"), F.col("z"))
    m = [F.get("a_m", i) for i in range(16)]
    world = [(m[4 * i] * cam[0] + m[4 * i + 1] * cam[1] + m[4 * i + 2] * cam[2] + m[4 * i + 3]).alias(n) for i, n in enumerate(("wx", "wy", "wz"))]
    points = own.select("scene", "src", F.struct(*world).alias("p")).groupBy("scene", "src").agg(F.collect_list("p").alias("points"))
    at = F.col("row") * F.col("w") + F.col("col")
    cells = cameras.select("scene", "view", "w", F.explode(F.sequence(F.lit(0), F.col("h") * F.col("w") - 1)).alias("at"))
    known = pixels.join(cameras.select("scene", "view", "w"), ["scene", "view"]).select("scene", "view", at.cast("int").alias("at"), "z")
    raster = cells.select("scene", "view", "at").join(known, ["scene", "view", "at"], "left").groupBy("scene", F.col("view").alias("dst")).agg(F.sort_array(F.collect_list(F.struct("at", "z"))).alias("raster"))
    b = cameras.select("scene", F.col("view").alias("dst"), *[F.col(c).alias(f"b_{c}") for c in ("fx", "fy", "cx", "cy", "h", "w", "inv")]).join(raster, ["scene", "dst"])
    met = pairs.select("scene", "src", "dst").join(points, ["scene", "src"]).join(b, ["scene", "dst"])
    spread = met.select("scene", "src", "dst", *[f"b_{c}" for c in ("fx", "fy", "cx", "cy", "h", "w", "inv")], "raster", F.explode("points").alias("p"))
    row, col, d = projected((F.col("p.wx"), F.col("p.wy"), F.col("p.wz")), [F.get("b_inv", i) for i in range(16)], *[F.col(f"b_{c}") for c in ("fx", "fy", "cx", "cy")])
    # Exploded, the place is a column of its own: a filter on it doesn't repeat the projection, and its code stays short.
    place = F.explode(F.array(F.struct(row.alias("pr"), col.alias("pc"), d.alias("d")))).alias("q")
    seen = spread.select("scene", "src", "dst", "b_h", "b_w", "raster", place).select("scene", "src", "dst", "b_h", "b_w", "raster", "q.pr", "q.pc", "q.d")
    seen = seen.filter((F.col("pr") >= 0) & (F.col("pc") >= 0) & (F.col("d") > min_depth) & (F.col("pr") < F.col("b_h")) & (F.col("pc") < F.col("b_w")))
    r, c = (F.least(F.rint(F.col(x)).try_cast("int"), F.col(f"b_{n}") - 1) for x, n in (("pr", "h"), ("pc", "w")))
    looked = seen.select("scene", "src", "dst", "d", F.get("raster", r * F.col("b_w") + c)["z"].alias("found"))
    limit = absolute + relative * F.col("d") - F.log(F.lit(0.5)) * temperature
    hits = looked.filter(F.abs(F.col("d") - F.col("found")) < limit).groupBy("scene", "src", "dst").agg(F.count(F.lit(1)).alias("hits"))
    if denominator == "full":
        area = cameras.select("scene", F.col("view").alias("src"), (F.col("h") * F.col("w")).alias("n"))
        return hits.join(area, ["scene", "src"]).select("scene", "src", "dst", (F.col("hits") / F.col("n")).alias("w"))
    valid = pixels.filter("z > 0").groupBy("scene", F.col("view").alias("dst")).agg(F.count(F.lit(1)).alias("n"))
    return hits.join(valid, ["scene", "dst"], "left").select("scene", "src", "dst", F.least(F.lit(1.0), F.col("hits") / F.greatest(F.coalesce("n", F.lit(1)), F.lit(1))).alias("w"))
