"""Colour as expressions over linear RGB columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Luma weights of ITU-R BT.709, middle grey, and the start of the shoulder.
LUMA = (0.2126, 0.7152, 0.0722)
GREY = 0.18
SHOULDER = 0.8
#: Fixed value: the constant term of real spherical harmonics, 1 / (2 * sqrt(pi)).
SH_C0 = 0.28209479177387814

RGB = tuple[Column, Column, Column]


def develop(rgb: RGB, exposure: float | Column = 0.0, balance: tuple[float, float, float] = (1.0, 1.0, 1.0), matrix: list[list[float]] | None = None, black: float = 0.0, contrast: float = 1.0, saturation: float = 1.0, soft: bool = True, gain: float | Column = 1.0) -> RGB:
    """Exposure in stops and a gain, white balance, colour matrix, black level (added), contrast about middle grey, saturation about luma, and a shoulder from 0 on (or a clip to 0..1)."""
    stops = F.pow(F.lit(2.0), exposure if isinstance(exposure, Column) else F.lit(exposure))
    c = [x * stops * gain * b for x, b in zip(rgb, balance, strict=True)]
    if matrix:
        c = [row[0] * c[0] + row[1] * c[1] + row[2] * c[2] for row in matrix]
    c = [(x + black - GREY) * contrast + GREY for x in c]
    luma = LUMA[0] * c[0] + LUMA[1] * c[1] + LUMA[2] * c[2]
    c = [luma + (x - luma) * saturation for x in c]
    top = 1 - SHOULDER
    shoulder = lambda x: F.when(x > SHOULDER, SHOULDER + top * (1 - F.exp(-(x - SHOULDER) / top))).otherwise(F.greatest(F.lit(0.0), x))
    return tuple(shoulder(x) if soft else clipped(x) for x in c)  # type: ignore[return-value]


def clipped(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def falloff(px: Column, py: Column, width: int, height: int, strength: float | Column) -> Column:
    """The light that a lens leaves at a pixel: 1 in the middle, less by the square of the distance, measured from -1 to 1 along either side."""
    across = lambda at, n: 2.0 * at / (n - 1) - 1 if n > 1 else F.lit(-1.0)
    x, y = across(px, width), across(py, height)
    return clipped(1 - strength * (x * x + y * y) / 2)


def finish(x: Column, gamma: float | Column, vignette: Column, noise: Column) -> Column:
    """One linear channel, clipped, with gamma, falloff and noise, clipped to [0, 1] again."""
    return clipped(F.pow(clipped(x), 1 / (gamma if isinstance(gamma, Column) else F.lit(gamma))) * vignette + noise)


def blended(before: Column, after: Column, share: Column) -> Column:
    """Two lenses' values in a crossfade."""
    return before * (1 - share) + after * share


def sh_to_byte(dc: Column) -> Column:
    """A channel from 0 to 255 of a constant harmonic term."""
    return F.rint(F.greatest(F.lit(0.0), F.least(F.lit(1.0), dc * SH_C0 + 0.5)) * 255).cast("int")


def opacity(x: Column, is_logit: bool) -> Column:
    return 1 / (1 + F.exp(-x)) if is_logit else F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def is_logit(least: Column, most: Column) -> Column:
    """Are opacities stored as logits? They are unless all lie between 0 and 1; aggregates of the finite ones are given."""
    return ~((least >= 0) & (most <= 1))
