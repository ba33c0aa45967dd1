"""Generators of positions, directions and motions. What is random depends on a seed and keys alone."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import Vec
from .stats import uniform

#: Irrational steps whose multiples spread evenly over [0, 1) in three dimensions.
STEPS = (0.6180339887498949, 0.7548776662466927, 0.5698402909980532)
#: Fixed value: pitches of neighbouring directions, as parts of half the range.
PITCHES = (0.0, -0.5, 0.5, -1.0, 1.0)


def spread(attempt: Column, phase: Column | float, axis: int) -> Column:
    """The number in [0, 1) of an attempt along an axis; every beginning of the sequence covers it evenly."""
    at = (phase if isinstance(phase, Column) else F.lit(phase)) + attempt * STEPS[axis]
    return at - F.floor(at)


def on_shell(attempt: Column, phases: tuple, azimuth: tuple[float, float], elevation: tuple[float, float], distance: tuple[float, float], frame: tuple[Vec, Vec, Vec], centre: Vec, radius: Column | float) -> Vec:
    """A position about a centre: azimuth even, elevation even in its sine, distance denser near the inner end. Angles in radians; frame: ahead, right and up."""
    a, b, c = (spread(attempt, p, i) for i, p in enumerate(phases))
    turn = azimuth[0] + a * (azimuth[1] - azimuth[0])
    low, high = math.sin(elevation[0]), math.sin(elevation[1])
    rise = F.asin(low + b * (high - low))
    far = (distance[0] + (distance[1] - distance[0]) * c * c) * radius
    ahead, right, up = frame
    return tuple(o + far * (F.cos(rise) * (F.cos(turn) * x + F.sin(turn) * y) + F.sin(rise) * z) for o, x, y, z in zip(centre, ahead, right, up, strict=True))


def stratified(index: Column, count: int, low: float, high: float, seed: int, *keys: Column) -> Column:
    """A number of the index-th of `count` equal parts of [low, high), at random within it."""
    width = (high - low) / count
    return low + (index + uniform(seed, *keys, index)) * width


def shuffled(values: Column, seed: int, *keys: Column) -> Column:
    """An array in an order that depends on seed and keys alone."""
    tagged = F.transform(values, lambda v, i: F.struct(F.xxhash64(F.lit(seed), *keys, i).alias("h"), i.alias("i"), v.alias("v")))
    return F.transform(F.array_sort(tagged), lambda x: x["v"])


def yaw_grid(index: Column, count: int, seed_yaw: float | None, span: float) -> Column:
    """The yaw of the index-th of `count` directions: all around from -180 on, or evenly over `span` degrees about a seed, ends included, where the direction next to the seed is the seed itself."""
    if seed_yaw is None:
        return -180.0 + index * (360.0 / count)
    if count == 1:
        return F.lit(float(seed_yaw))
    offsets = [-span / 2 + i * span / (count - 1) for i in range(count)]
    nearest = min(range(count), key=lambda i: (abs(offsets[i]), i))
    return seed_yaw + F.when(index == nearest, F.lit(0.0)).otherwise(-span / 2 + index * (span / (count - 1)))


def pitch_grid(index: Column, centre: float, span: float) -> Column:
    """Pitches that alternate about a centre."""
    return centre + F.element_at(F.array(*map(F.lit, PITCHES)), (index % len(PITCHES) + 1).cast("int")) * (span / 2)


def slow_motion(t: Column, axis: int, phase: Column | float, period: float) -> Column:
    """A slow sine from 0 to 1 in time, faster along later axes; it is still at the very beginning."""
    p = phase if isinstance(phase, Column) else F.lit(phase)
    return F.when(t == 0, 0.0).otherwise(F.sin(2 * math.pi * (axis + 1) * t / period + p))


def exterior_distance(way: Vec, low: list[float], high: list[float], centre: list[float], radius: float, margin: float) -> Column:
    """How far from the centre along a way a box is left, with a margin of so many radii, and by a little more so that the border counts as inside. Components under 1e-12 don't count; null if none does."""
    steps = [F.when(d > 1e-12, (h - c) / F.nullif(d, F.lit(0.0))).when(d < -1e-12, (lo - c) / F.nullif(d, F.lit(0.0))) for d, lo, h, c in zip(way, low, high, centre, strict=True)]
    nearest = F.least(*[F.when(s >= 0, s) for s in steps])
    return F.when(nearest.isNotNull(), F.greatest(nearest + (margin * radius + max(radius, 1.0) * 1e-9), F.lit(2.220446049250313e-16)))


def scene_kind(inside_share: Column) -> Column:
    """Cameras of which half or more are inside the scene's box look at an interior."""
    return F.when(inside_share >= 0.5, "interior").otherwise("object")


def inferred_kind(clearance: Column, radius: Column, extents: Vec) -> Column:
    """Without cameras: an object is dense in its middle and about as wide as high."""
    return F.when((clearance / radius < 0.01) & (F.greatest(*extents) / F.greatest(F.least(*extents), F.lit(1e-9)) < 2.0), "object").otherwise("interior")
