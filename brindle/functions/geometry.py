"""Vectors, poses, projections and rays as unrolled column expressions: x, y and z stay columns of their own, which keeps them inside generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Vec = tuple[Column, Column, Column]
Rows = tuple[Vec, Vec, Vec]


def dot(a: Vec, b: Vec) -> Column:
    """Components may be plain numbers; those that are 0 leave no term behind."""
    terms = [x * y for x, y in zip(a, b, strict=True) if not any(isinstance(z, float) and z == 0 for z in (x, y))]
    return sum(terms[1:], terms[0]) if terms else 0.0


def sub(a: Vec, b: Vec) -> Vec:
    return a[0] - b[0], a[1] - b[1], a[2] - b[2]


def cross(a: Vec, b: Vec) -> Vec:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Vec) -> Vec:
    """Null components for a vector of no length."""
    n = F.nullif(norm(a), F.lit(0.0))
    return a[0] / n, a[1] / n, a[2] / n


def apply(m: Rows, v: Vec) -> Vec:
    return dot(m[0], v), dot(m[1], v), dot(m[2], v)


def transpose(m: Rows) -> Rows:
    return tuple(tuple(m[j][i] for j in range(3)) for i in range(3))  # type: ignore[return-value]


def similarity(v: Vec, rotation: list[list[float]], shift: list[float], scale: float) -> Vec:
    """shift + scale * rotation * v."""
    rows = tuple(map(tuple, rotation))
    return tuple(F.lit(t) + scale * x for t, x in zip(shift, apply(rows, v), strict=True))  # type: ignore[arg-type,return-value]


def rigid_inverse(m: Rows, shift: Vec) -> tuple[Rows, Vec]:
    """Of the map v -> m v + shift with a rotation m."""
    t = transpose(m)
    moved = apply(t, shift)
    return t, (-moved[0], -moved[1], -moved[2])


def determinant(m: Rows) -> Column:
    return dot(m[0], cross(m[1], m[2]))


def orthonormal_error(m: Rows) -> Column:
    """The largest entry of m mᵀ less the identity."""
    return F.greatest(*(F.abs(dot(m[i], m[j]) - (1.0 if i == j else 0.0)) for i in range(3) for j in range(3)))


def quaternion_rows(w: Column, x: Column, y: Column, z: Column) -> Rows:
    """The rotation of a quaternion, which is normalised first."""
    n = F.nullif(F.sqrt(w * w + x * x + y * y + z * z), F.lit(0.0))
    w, x, y, z = w / n, x / n, y / n, z / n
    return (
        (1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)),
        (2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)),
        (2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)),
    )


def quaternion_of(m: Rows) -> tuple[Column, Column, Column, Column]:
    """(w, x, y, z) with w >= 0 of a rotation; sizes from the diagonal, signs from differences across it."""
    size = lambda a, b, c: F.sqrt(F.greatest(F.lit(0.0), 1 + a * m[0][0] + b * m[1][1] + c * m[2][2])) / 2
    signed = lambda v, d: F.when(d < 0, -v).otherwise(v)
    w = size(1, 1, 1)
    return w, signed(size(1, -1, -1), m[2][1] - m[1][2]), signed(size(-1, 1, -1), m[0][2] - m[2][0]), signed(size(-1, -1, 1), m[1][0] - m[0][1])


def look_at(eye: Vec, target: Vec, up: Vec) -> Rows:
    """Rows right, down and forward of a camera that looks from eye to target."""
    forward = unit(sub(target, eye))
    right = unit(cross(forward, up))
    return right, cross(forward, right), forward


def yaw_pitch(v: Vec) -> tuple[Column, Column]:
    """Degrees about y and over the horizon of a direction."""
    u = unit(v)
    return F.degrees(F.atan2(u[0], u[2])), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), u[1]))))


def direction(yaw: Column, pitch: Column) -> Vec:
    y, p = F.radians(yaw), F.radians(pitch)
    return F.sin(y) * F.cos(p), F.sin(p), F.cos(y) * F.cos(p)


def focal(fov_degrees: Column, pixels: Column) -> Column:
    return pixels / (2 * F.tan(F.radians(fov_degrees) / 2))


def fov(focal_pixels: Column, pixels: Column) -> Column:
    return F.degrees(2 * F.atan(pixels / (2 * focal_pixels)))


def zoomed_fov(fov_degrees: Column, zoom: Column) -> Column:
    """The field of view after the focal length is multiplied by zoom."""
    return F.degrees(2 * F.atan(F.tan(F.radians(fov_degrees) / 2) / zoom))


def projection_matrix(fx: Column, fy: Column, cx: Column, cy: Column, width: Column, height: Column, near: Column, far: Column) -> Column:
    """The 4 by 4 matrix to clip space, as an array of 16 in row order."""
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(
        2 * fx / width, zero, (2 * cx - width) / width, zero,
        zero, 2 * fy / height, (2 * cy - height) / height, zero,
        zero, zero, far / (far - near), -far * near / (far - near),
        zero, zero, one, zero,
    )


def pinhole(v: Vec, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column]:
    """Pixel of a point in camera coordinates; null on the camera's plane."""
    z = F.nullif(v[2], F.lit(0.0))
    return fx * v[0] / z + cx, fy * v[1] / z + cy


def screen_covariance(v: Vec, covariance: Rows, fx: float, fy: float, blur: float = 0.3) -> tuple[Column, Column, Column]:
    """(a, b, c) of the image covariance [[a, b], [b, c]] of a Gaussian at v, by the projection's Jacobian; blur is added to the diagonal."""
    z = F.nullif(v[2], F.lit(0.0))
    j = ((fx / z, 0.0, -fx * v[0] / (z * z)), (0.0, fy / z, -fy * v[1] / (z * z)))
    at = [apply(covariance, row) for row in j]
    return dot(j[0], at[0]) + blur, dot(j[0], at[1]), dot(j[1], at[1]) + blur


def ellipse_axes(a: Column, b: Column, c: Column, sigmas: float = 3.0) -> tuple[Column, Column]:
    """Half axes, major first, at so many deviations of a covariance [[a, b], [b, c]]."""
    middle, half = (a + c) / 2, F.sqrt((a - c) * (a - c) / 4 + b * b)
    return sigmas * F.sqrt(F.greatest(middle + half, F.lit(0.0))), sigmas * F.sqrt(F.greatest(middle - half, F.lit(0.0)))


def box_exit(origin: Vec, way: Vec, low: list[float], high: list[float]) -> Column:
    """How far a ray goes until it leaves a box that its origin is in; null for a direction of no length."""
    steps = [F.when(d > 0, (h - o) / F.nullif(d, F.lit(0.0))).when(d < 0, (lo - o) / F.nullif(d, F.lit(0.0))) for o, d, lo, h in zip(origin, way, low, high, strict=True)]
    return F.least(*steps)


def inside(v: Vec, low: list[float], high: list[float]) -> Column:
    """In a box, borders included."""
    return F.lit(True) & (v[0] >= low[0]) & (v[0] <= high[0]) & (v[1] >= low[1]) & (v[1] <= high[1]) & (v[2] >= low[2]) & (v[2] <= high[2])


def ball_offset(u: Column, v: Column, w: Column, radius: float) -> Vec:
    """A uniform offset in a ball from three uniform numbers."""
    r, z, turn = radius * F.cbrt(u), 2 * v - 1, 2 * math.pi * w
    flat = F.sqrt(F.greatest(F.lit(0.0), 1 - z * z))
    return r * flat * F.cos(turn), r * flat * F.sin(turn), r * z


def clip_planes(extent: Column, near_min: float, near_ratio: float, far_ratio: float, radius: Column | None = None, distance: Column | None = None) -> tuple[Column, Column]:
    """Near and far planes by the extent of what is about a camera. The far plane is ten times as far as the near one at least; with a scene's radius and distance it lies behind the scene instead."""
    near = F.greatest(F.lit(near_min), extent * near_ratio)
    if radius is None or distance is None:
        return near, F.greatest(near * 10, extent * far_ratio)
    return near, F.greatest(radius * far_ratio, distance + 2 * radius)


def composed(a: tuple[Column, ...], b: tuple[Column, ...]) -> tuple[Column, ...]:
    """The unit quaternion (w, x, y, z) of rotation b followed by a."""
    aw, ax, ay, az = a
    bw, bx, by, bz = b
    out = aw * bw - ax * bx - ay * by - az * bz, aw * bx + bw * ax + ay * bz - az * by, aw * by + bw * ay + az * bx - ax * bz, aw * bz + bw * az + ax * by - ay * bx
    length = F.sqrt(sum((x * x for x in out), F.lit(0.0)))
    return tuple(x / F.nullif(length, F.lit(0.0)) for x in out)


def decoded_scale(log_scale: Column, root: float = 1.0) -> Column:
    """A scale from its logarithm, which is taken between -30 and 30."""
    return root * F.exp(F.greatest(F.lit(-30.0), F.least(F.lit(30.0), log_scale)))
