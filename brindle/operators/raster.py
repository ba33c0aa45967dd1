"""Images as tables of pixels: coverage, ownership, connected background."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coverage(pixels: DataFrame, image: list[str], alpha: Column, threshold: float) -> DataFrame:
    """The share of pixels over the threshold."""
    return pixels.groupBy(*image).agg(F.avg((alpha > threshold).cast("double")).alias("coverage"))


#: Fixed value: what a splat adds to a pixel counts from here on.
LEAST_SHARE = 0.01


def candidates(splats: DataFrame, image: list[str], contribution: Column, tie: str, k: int = 64) -> DataFrame:
    """Each image's k splats with the largest contribution (opacity times area), with their `place` from 1; of equal ones the smaller tie value is first."""
    order = Window.partitionBy(*image) if image else Window.partitionBy(F.lit(1))
    return splats.withColumn("place", F.row_number().over(order.orderBy(contribution.desc(), tie)).cast("long")).where(F.col("place") <= k)


def footprints(splats: DataFrame, width: int, height: int, least: float = LEAST_SHARE) -> DataFrame:
    """The pixels that each splat (u, v, a, b, c, reach, weight) touches: its box cut to the image, then the exact ellipse test at three deviations. Adds px, py and `share`, the splat's weight at the pixel's centre, if it is at least `least`."""
    span = lambda at, size: F.sequence(F.greatest(F.lit(0), F.floor(F.col(at) - F.col("reach")).cast("int")), F.least(F.lit(size - 1), F.floor(F.col(at) + F.col("reach")).cast("int")))
    inside = (F.col("u") + F.col("reach") >= 0) & (F.col("u") - F.col("reach") < width) & (F.col("v") + F.col("reach") >= 0) & (F.col("v") - F.col("reach") < height)
    rows = splats.where(inside).withColumn("px", F.explode(span("u", width))).withColumn("py", F.explode(span("v", height)))
    dx, dy = F.col("px") + 0.5 - F.col("u"), F.col("py") + 0.5 - F.col("v")
    det = F.col("a") * F.col("c") - F.col("b") * F.col("b")
    m = (F.col("c") * dx * dx - 2 * F.col("b") * dx * dy + F.col("a") * dy * dy) / det
    return rows.withColumn("m", m).where("m <= 9").withColumn("share", F.col("weight") * F.exp(-F.col("m") / 2)).where(F.col("share") >= least).drop("m")


def ownership(touches: DataFrame, image: list[str], splat: str, order: str) -> DataFrame:
    """Each pixel's owner: the largest share, the earliest in order of those that tie; and how many splats overlap there."""
    per = touches.groupBy(*image, "px", "py").agg(F.max_by(splat, F.struct(F.col("share"), (-F.col(order)).alias("o"))).alias("owner"), F.count(F.lit(1)).alias("layers"))
    return per


def dominance(owners: DataFrame, image: list[str], pixels: int, top: int = 5) -> DataFrame:
    """Of each image: the share of the pixels that its largest owner and its `top` largest ones hold, the share with two layers or more, and the most layers."""
    counts = owners.groupBy(*image, "owner").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*image).orderBy(F.desc("n"), "owner") if image else Window.partitionBy(F.lit(1)).orderBy(F.desc("n"), "owner")
    ranked = counts.withColumn("k", F.row_number().over(w)).where(F.col("k") <= top)
    best = ranked.groupBy(*image).agg(F.max("n").alias("n1"), F.sum("n").alias("n5"))
    layers = owners.groupBy(*image).agg(F.count(F.lit(1)).alias("covered"), F.count_if(F.col("layers") >= 2).alias("multi"), F.max("layers").alias("max_layers"))
    both = layers.join(best, image) if image else layers.join(F.broadcast(best), F.lit(True))
    part = lambda c: F.col(c) / F.lit(float(pixels))
    return both.select(*image, part("covered").alias("coverage"), part("n1").alias("largest_share"), part("n5").alias("top_share"), part("multi").alias("overlap_share"), "max_layers")


def largest_background(pixels: DataFrame, image: list[str], width: int, height: int) -> DataFrame:
    """The largest 8-connected patch of pixels that aren't `covered`, as a share of the image; one image is one task's work."""

    def size(rows: pd.DataFrame) -> pd.DataFrame:
        free = np.zeros((height + 2, width + 2), bool)
        free[1:-1, 1:-1] = True
        on = rows[rows["covered"]]
        free[on["py"].to_numpy() + 1, on["px"].to_numpy() + 1] = False
        label = np.where(free, np.arange(free.size).reshape(free.shape), -1)
        while True:  # each pixel takes the largest label about it; ends after the longest way through a patch
            best = label.copy()
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    best[1:-1, 1:-1] = np.maximum(best[1:-1, 1:-1], label[1 + dy : height + 1 + dy, 1 + dx : width + 1 + dx])
            best = np.where(free, best, -1)
            jumped = np.where(free, np.maximum(best, best.ravel()[np.maximum(best, 0)]), -1)
            if (jumped == label).all():
                break
            label = jumped
        found = np.bincount(label[free]).max() if free.any() else 0
        return rows.iloc[:1][image].assign(largest_background=float(found) / (width * height))

    schema = ", ".join([*(f"`{c}` {dict(pixels.dtypes)[c]}" for c in image), "largest_background double"])
    return pixels.groupBy(*image).applyInPandas(size, schema)
