"""Numerics that need linear algebra, as Arrow-batched functions of array columns."""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest_rotation(matrix: Column) -> Column:
    """Of nine numbers, row by row: the rotation that is closest to them, as nine numbers."""

    @F.pandas_udf("array<double>")
    def run(values: pd.Series) -> pd.Series:
        u, _, v = np.linalg.svd(np.stack(values.to_numpy()).reshape(-1, 3, 3).astype(float))
        u[np.linalg.det(u @ v) < 0, :, 2] *= -1
        return pd.Series(list((u @ v).reshape(-1, 9)))

    return run(matrix)


def natural_spline(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The natural cubic spline through (x, y), x rising; straight with two points, flat with one."""
    n = len(x)
    if n < 3:
        return np.interp(at, x, y)
    h, slope = np.diff(x), np.diff(y) / np.diff(x)
    m = np.zeros((n, n))
    m[0, 0] = m[-1, -1] = 1
    i = np.arange(1, n - 1)
    m[i, i - 1], m[i, i], m[i, i + 1] = h[:-1], 2 * (h[:-1] + h[1:]), h[1:]
    bend = np.linalg.solve(m, np.concatenate([[0], 6 * np.diff(slope), [0]]))
    k = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    a, b = x[k + 1] - at, at - x[k]
    return (bend[k] * a**3 + bend[k + 1] * b**3) / (6 * h[k]) + (y[k] / h[k] - bend[k] * h[k] / 6) * a + (y[k + 1] / h[k] - bend[k + 1] * h[k] / 6) * b


def spline(x: Column, y: Column, at: Column) -> Column:
    """`natural_spline` over array columns."""

    @F.pandas_udf("array<double>")
    def run(xs: pd.Series, ys: pd.Series, ats: pd.Series) -> pd.Series:
        return pd.Series([natural_spline(*(np.asarray(v, float) for v in r)) for r in zip(xs, ys, ats, strict=True)])

    return run(x, y, at)


def blurred(image: np.ndarray, sigma: float, taps: int) -> np.ndarray:
    """A Gaussian filter of so many taps along either side; beyond the border the image is mirrored about its outermost pixels."""
    at = np.arange(taps) - (taps - 1) / 2
    kernel = np.exp(-(at**2) / (2 * sigma * sigma))
    kernel /= kernel.sum()
    reach = taps // 2
    for axis in (0, 1):
        wide = np.pad(image, [(reach, reach) if i == axis else (0, 0) for i in (0, 1)], mode="reflect" if image.shape[axis] > 1 else "edge")
        n = image.shape[axis]
        image = sum(k * np.take(wide, np.arange(i, i + n), axis=axis) for i, k in enumerate(kernel))
    return image


def gradient(image: np.ndarray) -> np.ndarray:
    """The length of Sobel's gradient."""
    wide = np.pad(image, 1, mode="reflect" if min(image.shape) > 1 else "edge")
    rows, columns = wide[:-2] + 2 * wide[1:-1] + wide[2:], wide[:, :-2] + 2 * wide[:, 1:-1] + wide[:, 2:]
    return np.hypot(rows[:, 2:] - rows[:, :-2], columns[2:] - columns[:-2])


def ssim(a: np.ndarray, b: np.ndarray) -> float:
    """Structural similarity of two grey images from 0 to 1: the mean over windows of 11 by 11 with Gaussian weights of deviation 1.5, between -1 and 1."""
    mean = lambda x: blurred(x, 1.5, 11)
    ma, mb = mean(a), mean(b)
    va, vb, cov = mean(a * a) - ma * ma, mean(b * b) - mb * mb, mean(a * b) - ma * mb
    c1, c2 = 0.01**2, 0.03**2
    return float(np.clip(np.mean((2 * ma * mb + c1) * (2 * cov + c2) / ((ma * ma + mb * mb + c1) * (va + vb + c2))), -1, 1))


def structural_features(rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A colour image's grey values, with their contrast made alike and lightly blurred, and its gradient relative to its 95 % quantile, both from 0 to 1."""
    grey = np.clip(rgb, 0, 1) @ np.array([0.299, 0.587, 0.114])
    even = np.clip((grey - grey.mean()) / (grey.std() + 1e-5), -2.5, 2.5) / 5 + 0.5
    even = blurred(even, 0.7, 7)
    edges = gradient(even)
    return np.clip(even, 0, 1), np.clip(edges / (np.quantile(edges, 0.95) + 1e-5), 0, 1)


def structural_loss(rgb: np.ndarray, reference: tuple[np.ndarray, np.ndarray], grey_weight: float, gradient_weight: float, ssim_weight: float) -> dict[str, float]:
    """How far an image is from the features of a reference: mean differences of grey values and gradients, 1 - SSIM, and their weighted sum."""
    grey, edges = structural_features(rgb)
    parts = {"grayscale": float(np.abs(grey - reference[0]).mean()), "gradient": float(np.abs(edges - reference[1]).mean()), "one_minus_ssim": 1 - ssim(grey, reference[0])}
    return parts | {"weighted_total": grey_weight * parts["grayscale"] + gradient_weight * parts["gradient"] + ssim_weight * parts["one_minus_ssim"]}


def structural_similarity(a: Column, b: Column, width: int) -> Column:
    """`ssim` of two equally large grey images, as arrays row by row."""

    @F.pandas_udf("double")
    def run(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series([ssim(*(np.asarray(v, float).reshape(-1, width) for v in pair)) for pair in zip(first, second, strict=True)])

    return run(a, b)


def similarity_of(loss: Column) -> Column:
    return 1 / (1 + loss)


def trimmed(image: np.ndarray) -> tuple[np.ndarray, tuple[int, int, int, int]]:
    """A grey image (0 to 255) without dark or bright bars at its borders, and what is left of it as (x, y, width, height). A row or column is part of a bar if its deviation is under 2 and its mean under 8 or over 247; from each side a quarter goes at most."""
    height, width = image.shape

    def span(deviation: np.ndarray, mean: np.ndarray, n: int) -> tuple[int, int]:
        bar = (deviation < 2) & ((mean < 8) | (mean > 247))
        low, high = 0, n
        while low < n // 4 and bar[low]:
            low += 1
        while high > 3 * n // 4 and bar[high - 1]:
            high -= 1
        return low, high

    top, bottom = span(image.std(axis=1), image.mean(axis=1), height)
    left, right = span(image.std(axis=0), image.mean(axis=0), width)
    return image[top:bottom, left:right], (left, top, right - left, bottom - top)


def centre_cut(width: int, height: int, to_width: int, to_height: int) -> tuple[int, int, int, int]:
    """The largest middle part (x, y, width, height) of an image that has another one's proportions; halves go to the even number."""
    if width * to_height > height * to_width:
        new = round(height * to_width / to_height)
        return (width - new) // 2, 0, new, height
    if width * to_height < height * to_width:
        new = round(width / (to_width / to_height))
        return 0, (height - new) // 2, width, new
    return 0, 0, width, height
