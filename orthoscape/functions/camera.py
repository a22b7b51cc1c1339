"""Cameras, poses and quaternions in closed form, as columns.

Matrices are flat arrays, row by row; quaternions are (x, y, z, w).  Closed
forms of element access stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]
Quat = tuple[Column, Column, Column, Column]


def at(m: Column, i: int, j: int, n: int = 4) -> Column:
    return F.get(m, F.lit(n * i + j))


def rotation(m: Column, n: int = 4) -> list[list[Column]]:
    return [[at(m, i, j, n) for j in range(3)] for i in range(3)]


def hfov(width: Column, fx: Column) -> Column:
    return F.degrees(2 * F.atan(width / (2 * fx)))


def focal(width: Column, fov: Column) -> Column:
    """Focal length in pixels of a horizontal field of view in (0, 179) degrees; others are an error."""
    return F.when((fov > 0) & (fov < 179), width / (2 * F.tan(F.radians(fov) / 2))).otherwise(F.raise_error(F.lit("field of view out of range")))


def same_footprint(height: Column, fov: Column, new_fov: Column) -> Column:
    """The distance at which a new field of view covers the old footprint."""
    return height * F.tan(F.radians(fov) / 2) / F.tan(F.radians(new_fov) / 2)


def pinhole(model: Column, fx: Column, fy: Column, cx: Column, cy: Column, distortion: Column) -> Column:
    """K as nine numbers; other models and any distortion are an error."""
    k = F.array(fx, F.lit(0.0), cx, F.lit(0.0), fy, cy, F.lit(0.0), F.lit(0.0), F.lit(1.0))
    return F.when(model != "PINHOLE", F.raise_error(F.concat(F.lit("not a pinhole camera: "), model))).when(distortion != 0, F.raise_error(F.lit("distorted camera"))).otherwise(k)


def colmap_intrinsics(model: Column, p: Column, scale: float = 1.0) -> tuple[Column, Column, Column, Column]:
    """(fx, fy, cx, cy) of a camera's parameters; PINHOLE has two focal lengths, all others one."""
    two = model == "PINHOLE"
    g = lambda i: F.get(p, F.lit(i)) * scale
    return g(0), F.when(two, g(1)).otherwise(g(0)), F.when(two, g(2)).otherwise(g(1)), F.when(two, g(3)).otherwise(g(2))


def inverse_rigid(m: Column) -> Column:
    """[R^T, -R^T t] of a rigid 4x4."""
    r, t = rotation(m), [at(m, i, 3) for i in range(3)]
    rows = []
    for i in range(3):
        rows += [r[0][i], r[1][i], r[2][i], -(r[0][i] * t[0] + r[1][i] * t[1] + r[2][i] * t[2])]
    return F.array(*rows, F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def inverse_upper(k: Column) -> Column:
    """Inverse of an upper triangular 3x3 with unit last entry, skew included."""
    a, s, cx, b, cy = at(k, 0, 0, 3), at(k, 0, 1, 3), at(k, 0, 2, 3), at(k, 1, 1, 3), at(k, 1, 2, 3)
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(1 / a, -s / (a * b), (s * cy - cx * b) / (a * b), zero, 1 / b, -cy / b, zero, zero, one)


def product(a: Column, b: Column) -> Column:
    return F.array(*[sum((at(a, i, k) * at(b, k, j) for k in range(1, 4)), at(a, i, 0) * at(b, 0, j)) for i in range(4) for j in range(4)])


def relative_pose(a: Column, b: Column) -> Column:
    """inv(a) b of two camera-to-world poses."""
    return product(inverse_rigid(a), b)


def centre(world_to_cam: Column) -> Vec:
    """-R^T t."""
    r, t = rotation(world_to_cam), [at(world_to_cam, i, 3) for i in range(3)]
    return tuple(-(r[0][i] * t[0] + r[1][i] * t[1] + r[2][i] * t[2]) for i in range(3))


def forward(world_to_cam: Column, sign: int = 1) -> Vec:
    """R^T (0, 0, sign)."""
    return tuple(at(world_to_cam, 2, i) * sign for i in range(3))


def shifted(world_to_cam: Column, offset: Vec) -> Column:
    """The extrinsic after the world moves: t + R offset."""
    r = rotation(world_to_cam)
    t = [at(world_to_cam, i, 3) + sum((r[i][k] * offset[k] for k in range(1, 3)), r[i][0] * offset[0]) for i in range(3)]
    return F.array(*[x for i in range(3) for x in (*r[i], t[i])], F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def flipped_axes(m: Column) -> Column:
    """Between the OpenGL and the OpenCV camera: columns 1 and 2 change sign."""
    return F.array(*[at(m, i, j) * (-1 if j in (1, 2) else 1) for i in range(4) for j in range(4)])


def quaternion_to_rotation(q: Quat) -> Column:
    """Nine numbers of a quaternion of any length."""
    n = F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3])
    x, y, z, w = (c / n for c in q)
    return F.array(1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y))


def rotation_to_quaternion(m: Column) -> Column:
    """(x, y, z, w) by the best-conditioned of four forms, the first on ties, with w >= 0."""
    r = [[at(m, i, j, 3) for j in range(3)] for i in range(3)]
    trace = [1 + r[0][0] + r[1][1] + r[2][2], 1 + r[0][0] - r[1][1] - r[2][2], 1 - r[0][0] + r[1][1] - r[2][2], 1 - r[0][0] - r[1][1] + r[2][2]]
    size = [F.sqrt(F.greatest(F.lit(0.0), t)) for t in trace]
    a, b, c = r[2][1] - r[1][2], r[0][2] - r[2][0], r[1][0] - r[0][1]
    d, e, f = r[1][0] + r[0][1], r[0][2] + r[2][0], r[1][2] + r[2][1]
    forms = [(size[0] * size[0], a, b, c), (a, size[1] * size[1], d, e), (b, d, size[2] * size[2], f), (c, e, f, size[3] * size[3])]
    top = F.greatest(*size)

    def part(k: int) -> Column:
        out = forms[3][k] / (2 * F.greatest(size[3], F.lit(0.1)))
        for i in (2, 1, 0):
            out = F.when(size[i] >= top, forms[i][k] / (2 * F.greatest(size[i], F.lit(0.1)))).otherwise(out)
        return out

    w, x, y, z = (part(k) for k in range(4))
    sign = F.when(w < 0, -1.0).otherwise(1.0)
    return F.array(x * sign, y * sign, z * sign, w * sign)


def quaternion_inverse(q: Quat) -> Quat:
    n = q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3]
    return -q[0] / n, -q[1] / n, -q[2] / n, q[3] / n


def quaternion_product(a: Quat, b: Quat) -> Quat:
    ax, ay, az, aw = a
    bx, by, bz, bw = b
    return aw * bx + ax * bw + ay * bz - az * by, aw * by - ax * bz + ay * bw + az * bx, aw * bz + ax * by - ay * bx + az * bw, aw * bw - ax * bx - ay * by - az * bz


def slerp(a: Quat, b: Quat, t: Column) -> Quat:
    """Along the shortest arc; nearly equal ones are mixed linearly and normalised."""
    dot = sum((x * y for x, y in zip(a[1:], b[1:], strict=True)), a[0] * b[0])
    b = tuple(F.when(dot < 0, -y).otherwise(y) for y in b)
    dot = F.least(F.abs(dot), F.lit(1.0))
    angle = F.acos(dot)
    near = dot > 0.9995
    safe = F.when(near, 1.0).otherwise(F.sin(angle))
    wa, wb = F.when(near, 1 - t).otherwise(F.sin((1 - t) * angle) / safe), F.when(near, t).otherwise(F.sin(t * angle) / safe)
    mixed = [wa * x + wb * y for x, y in zip(a, b, strict=True)]
    n = F.sqrt(sum((x * x for x in mixed[1:]), mixed[0] * mixed[0]))
    return tuple(x / n for x in mixed)


def opk_rotation(omega: Column, phi: Column, kappa: Column) -> Column:
    """Rx(omega) Ry(phi) Rz(kappa), in degrees, as nine numbers."""
    (so, co), (sp, cp), (sk, ck) = ((F.sin(F.radians(a)), F.cos(F.radians(a))) for a in (omega, phi, kappa))
    return F.array(cp * ck, -cp * sk, sp, co * sk + so * sp * ck, co * ck - so * sp * sk, -so * cp, so * sk - co * sp * ck, so * ck + co * sp * sk, co * cp)


def resized_intrinsics(fx: Column, cx: Column, scale: Column) -> tuple[Column, Column]:
    """Focal length and principal point under a resize with half-pixel centres."""
    return fx * scale, (cx + 0.5) * scale - 0.5


def rotated_intrinsics(fx: Column, fy: Column, cx: Column, cy: Column, w: Column, h: Column, quarter: int) -> tuple[Column, ...]:
    """(fx, fy, cx, cy, w, h) after ``quarter`` clockwise quarter turns."""
    for _ in range(quarter % 4):
        fx, fy, cx, cy, w, h = fy, fx, h - 1 - cy, cx, h, w
    return fx, fy, cx, cy, w, h


def longest_side(w: Column, h: Column, target: int, multiple: int = 1, enlarge: bool = False) -> tuple[Column, Column]:
    """Size under a longest side, truncated, then down to a multiple; images aren't enlarged unless asked."""
    scale = F.lit(float(target)) / F.greatest(w, h)
    scale = scale if enlarge else F.least(F.lit(1.0), scale)
    return tuple((F.floor((x * scale).cast("int") / multiple) * multiple).cast("int") for x in (w, h))


def centred_crop(w: Column, h: Column, cx: Column, cy: Column) -> tuple[Column, Column, Column, Column]:
    """The largest box (left, top, right, bottom) in the image with the principal point at its middle."""
    mx, my = F.least(cx, w - 1 - cx), F.least(cy, h - 1 - cy)
    return tuple(x.cast("int") for x in (F.floor(cx - mx), F.floor(cy - my), F.floor(cx + mx) + 1, F.floor(cy + my) + 1))


def look_at(f: Vec, up: Vec = None) -> Column:
    """Camera axes (right, down, forward) as rows, from a forward vector."""
    up = up or (F.lit(0.0), F.lit(0.0), F.lit(1.0))
    n = F.sqrt(f[0] * f[0] + f[1] * f[1] + f[2] * f[2])
    f = tuple(x / n for x in f)
    r = cross(f, up)
    m = F.sqrt(r[0] * r[0] + r[1] * r[1] + r[2] * r[2])
    r = tuple(F.when(m > 1e-9, x / F.greatest(m, F.lit(1e-9))).otherwise(F.lit(float(i == 0))) for i, x in enumerate(r))
    d = cross(f, r)
    return F.array(*r, *d, *f)


def cross(a: Vec, b: Vec) -> Vec:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def yaw_pitch(yaw: Column, pitch: Column) -> Vec:
    """A unit vector; yaw from x towards y, pitch upwards, in degrees."""
    y, p = F.radians(yaw), F.radians(pitch)
    return F.cos(p) * F.cos(y), F.cos(p) * F.sin(y), F.sin(p)


def catmull_rom(p: list[Column], t: Column, knots: list[Column]) -> Column:
    """Centripetal Catmull-Rom between p[1] and p[2], by the pyramid of linear steps; t in knot units."""

    def mix(a: Column, b: Column, lo: Column, hi: Column) -> Column:
        return ((hi - t) * a + (t - lo) * b) / F.greatest(hi - lo, F.lit(1e-12))

    k = knots
    a = [mix(p[i], p[i + 1], k[i], k[i + 1]) for i in range(3)]
    b = [mix(a[i], a[i + 1], k[i], k[i + 2]) for i in range(2)]
    return mix(b[0], b[1], k[1], k[2])


def rotation_error(a: Quat, b: Quat) -> Column:
    """Degrees between two unit quaternions."""
    dot = sum((x * y for x, y in zip(a[1:], b[1:], strict=True)), a[0] * b[0])
    return F.degrees(2 * F.acos(F.least(F.lit(1.0), F.abs(dot))))


def direction_error(a: Vec, b: Vec) -> Column:
    """Degrees between two translations up to sign; a zero one counts as 1e6 radians."""
    n = F.sqrt(sum((x * x for x in a[1:]), a[0] * a[0])) * F.sqrt(sum((x * x for x in b[1:]), b[0] * b[0]))
    dot = sum((x * y for x, y in zip(a[1:], b[1:], strict=True)), a[0] * b[0])
    angle = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(dot, n)))))
    return F.coalesce(F.least(angle, 180 - angle), F.degrees(F.lit(1e6)))


def vector_angle(a: Vec, b: Vec) -> Column:
    c = cross(a, b)
    return F.atan2(F.sqrt(c[0] * c[0] + c[1] * c[1] + c[2] * c[2]), a[0] * b[0] + a[1] * b[1] + a[2] * b[2])
