"""Points in space: bounds, neighbours, separation, voxels.

Neighbour searches are equi-joins on grid cells: a point meets the 27 cells about it, and never all other points.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import finite
from ..session import checkpointed
from .quantiles import quantiles, with_quantiles

XYZ = ("x", "y", "z")


def cells(size: float) -> list[Column]:
    return [F.floor(F.col(c) / size).cast("long").alias(f"c{c}") for c in XYZ]


def around(reach: int = 1) -> Column:
    """The cells within `reach` of a point's own, exploded to structs (cx, cy, cz)."""
    step = F.sequence(F.lit(-reach), F.lit(reach))
    return F.explode(F.flatten(F.transform(step, lambda i: F.flatten(F.transform(step, lambda j: F.transform(step, lambda k: F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy"), (F.col("cz") + k).alias("cz"))))))))


def within(df: DataFrame, id_col: str, distance: float, closed: bool = False) -> DataFrame:
    """Pairs (a < b) of points nearer than `distance` (or at it, if closed), with their distance. Cells are as wide as the distance."""
    points = df.select(F.col(id_col).alias("id"), *XYZ, *cells(distance))
    left = points.select(F.col("id").alias("a"), *[F.col(c).alias(f"a{c}") for c in XYZ], around().alias("cell")).select("a", "ax", "ay", "az", "cell.*")
    right = points.select(F.col("id").alias("b"), *[F.col(c).alias(f"b{c}") for c in XYZ], "cx", "cy", "cz")
    d = F.sqrt(sum(((F.col(f"a{c}") - F.col(f"b{c}")) * (F.col(f"a{c}") - F.col(f"b{c}")) for c in XYZ), F.lit(0.0)))
    pairs = left.join(right, ["cx", "cy", "cz"]).where("a < b").select("a", "b", d.alias("distance"))
    return pairs.where((F.col("distance") <= distance) if closed else (F.col("distance") < distance))


def nearest(df: DataFrame, id_col: str, k: int = 1, cell: float | None = None) -> DataFrame:
    """Each point's k nearest others: (id_col, neighbour, distance, rank), ties to the smaller id.

    Points look among the 27 cells about their own. What is found within one cell's width is certain; points with fewer
    than k certain ones go on with cells twice as wide, until cells hold everything. Each round only carries the points
    that are left, so dense regions are settled with small cells.
    """

    points = df.select(F.col(id_col).alias("id"), *XYZ)
    bounds = points.agg(F.count(F.lit(1)), *[f(c) for c in XYZ for f in (F.min, F.max)]).head()
    n, spans = bounds[0], [bounds[2 + 2 * i] - bounds[1 + 2 * i] if bounds[0] else 0.0 for i in range(3)]
    widest = max([*spans, 1e-9])
    size = cell or widest / max(1.0, (n / (k + 1)) ** (1 / 3))
    left, done = points, None
    while True:
        last = size >= widest
        own = left.select("*", *cells(size))
        near = own.select("id", *XYZ, around().alias("cell")).select("id", *XYZ, "cell.*")
        other = points.select(F.col("id").alias("neighbour"), *[F.col(c).alias(f"o{c}") for c in XYZ], *cells(size))
        d = F.sqrt(sum(((F.col(c) - F.col(f"o{c}")) * (F.col(c) - F.col(f"o{c}")) for c in XYZ), F.lit(0.0)))
        found = near.join(other, ["cx", "cy", "cz"]).where("id <> neighbour").select("id", "neighbour", d.alias("distance"))
        order = Window.partitionBy("id").orderBy("distance", "neighbour")
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        if last:
            out = best
        else:
            sure = best.groupBy("id").agg(F.max("distance").alias("far"), F.count(F.lit(1)).alias("n")).where((F.col("n") == k) & (F.col("far") <= size)).select("id")
            sure = checkpointed(sure)
            out, left = checkpointed(best.join(sure, "id", "left_semi")), checkpointed(left.join(sure, "id", "left_anti"))
        done = out if done is None else done.union(out)
        if last or left.limit(1).count() == 0:
            break
        size *= 2
    return done.select(F.col("id").alias(id_col), "neighbour", "distance", "rank")


def strided(df: DataFrame, number: str, most: int) -> DataFrame:
    """Every ceil(n / most)-th row from the first, by a column that numbers all rows from 0."""
    return df.where(F.col(number) % max(1, -(-df.count() // most)) == 0)


def voxels(df: DataFrame, size: float) -> DataFrame:
    """Occupied cells and how many points each holds."""
    return df.select(*cells(size)).groupBy("cx", "cy", "cz").agg(F.count(F.lit(1)).alias("points"))


def separated(df: DataFrame, groups: list[str], order: str, distance: float) -> DataFrame:
    """Of each group, in order, the points that keep `distance` from all that were taken before. Sequential by nature: a group is one task's work, and a grid of taken points makes each test a look at 27 cells."""

    def take(rows: pd.DataFrame) -> pd.DataFrame:
        taken: dict[tuple[int, int, int], list[np.ndarray]] = {}
        keep = []
        for p in rows.sort_values(order, kind="stable")[[*XYZ, order]].itertuples(index=True):
            v = np.array([p.x, p.y, p.z])
            c = tuple(int(i) for i in np.floor(v / distance))
            near = (q for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) for q in taken.get((c[0] + i, c[1] + j, c[2] + k), ()))
            if all(np.linalg.norm(v - q) >= distance for q in near):
                taken.setdefault(c, []).append(v)
                keep.append(p.Index)
        return rows.loc[keep]

    keyed = df if groups else df.withColumn("__all", F.lit(1))
    return keyed.groupBy(*(groups or ["__all"])).applyInPandas(take, keyed.schema).drop("__all")


def reject_counts(df: DataFrame, alpha: Column, least_alpha: float, low: list[float], high: list[float], filtering: bool) -> DataFrame:
    """How many points aren't finite, are too clear, or lie outside the box (each point counts once, in that order), and how many are effective: the rest, or, without filtering, all finite ones."""
    good = finite(F.col("x")) & finite(F.col("y")) & finite(F.col("z")) & finite(alpha)
    box = F.lit(True)
    for c, a, b in zip(XYZ, low, high, strict=True):
        box = box & (F.col(c) >= a) & (F.col(c) <= b)
    clear = good & (alpha < least_alpha)
    return df.agg(F.count_if(~good).alias("nonfinite"), F.count_if(clear).alias("low_opacity"), F.count_if(good & ~clear & ~box).alias("outlier"), F.count_if((good & ~clear & box) if filtering else good).alias("effective"))


def robust_bounds(df: DataFrame, low: float = 0.01, high: float = 0.99, scales: tuple[Column, Column, Column] | None = None, sigmas: float = 3.0, most_scale: float = 0.99) -> DataFrame:
    """Where a cloud of points lies, far ones aside: one row.

    `n` points; `<axis>_low` and `_high`: exact quantiles, the bounds of points that count; `kept` of them lie within all
    bounds. If that are fewer than four (or than n), the bounds are those of all points. Over the points kept:
    `<axis>_centre`: the median; `<axis>_cap`: a quantile of the scales, which larger ones are cut to; `<axis>_min` and
    `_max`: the low quantile of points less `sigmas` scales and the high one of points and `sigmas` scales; `radius` from
    the centre to the farthest corner of that box. Without scales points have no extent.
    """
    wide = dict(zip(XYZ, scales or (F.lit(0.0),) * 3, strict=True))
    df = df.select(*(F.col(c).cast("double").alias(c) for c in XYZ), *(v.alias(f"s{c}") for c, v in wide.items()))
    at = {c: F.col(c) for c in XYZ}
    first = with_quantiles(df.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{s}{c}") for c in XYZ for s, f in (("least_", F.min), ("most_", F.max))]), df, [], {f"{c}_{s}": (at[c], p) for c in XYZ for s, p in (("low", low), ("high", high))}).head()
    box = {c: (first[f"{c}_low"], first[f"{c}_high"]) for c in XYZ}
    if not first["n"]:
        raise ValueError("there are no points")
    within_box = lambda: all_of([F.col(c).between(*box[c]) for c in XYZ])
    kept = df.where(within_box()).count()
    if kept < min(4, first["n"]):
        box, kept = {c: (first[f"least_{c}"], first[f"most_{c}"]) for c in XYZ}, first["n"]
    rows = df.where(within_box())
    size = {c: F.col(f"s{c}") for c in XYZ}
    middle = quantiles(rows, [], {f"{c}_centre": (at[c], 0.5) for c in XYZ} | {f"{c}_cap": (size[c], most_scale) for c in XYZ}).head()
    reach = {c: sigmas * F.least(F.col(f"s{c}"), F.lit(middle[f"{c}_cap"])) for c in XYZ}
    ends = quantiles(rows, [], {f"{c}_min": (F.col(c) - reach[c], low) for c in XYZ} | {f"{c}_max": (F.col(c) + reach[c], high) for c in XYZ})
    fixed = {"n": first["n"], "kept": kept} | {f"{c}_{s}": box[c][i] for c in XYZ for i, s in enumerate(("low", "high"))} | {k: middle[k] for c in XYZ for k in (f"{c}_centre", f"{c}_cap")}
    corner = [F.greatest(F.abs(F.col(f"{c}_max") - middle[f"{c}_centre"]), F.abs(F.col(f"{c}_min") - middle[f"{c}_centre"])) for c in XYZ]
    radius = F.greatest(F.sqrt(sum((r * r for r in corner), F.lit(0.0))), F.lit(1.1920928955078125e-07))
    return ends.select(*(F.lit(v).alias(k) for k, v in fixed.items()), *ends.columns, radius.alias("radius"))


def all_of(conditions: list[Column]) -> Column:
    """All of them."""
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
