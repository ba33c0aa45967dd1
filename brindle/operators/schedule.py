"""Schedules of frames over lenses with zoom ranges, crossfades and temporal jumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def frames(lenses: DataFrame) -> DataFrame:
    """A row for each frame of each lens (lens_index, zoom_min, zoom_max, frame_count): `local` from 0, `frame_index` over all, and the start of its lens."""
    start = F.coalesce(F.sum("frame_count").over(Window.partitionBy(F.lit(1)).orderBy("lens_index").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # lenses: a handful
    rows = lenses.withColumn("start", start.cast("long")).where("frame_count > 0")
    return rows.withColumn("local", F.explode(F.sequence(F.lit(0).cast("long"), F.col("frame_count").cast("long") - 1))).withColumn("frame_index", F.col("start") + F.col("local"))


def progress(local: Column, count: Column, smooth: bool = False) -> Column:
    """From 0 at the first to 1 at the last frame, exactly; a lens of one frame stays at 0."""
    t = F.when(count > 1, local / F.greatest(count - 1, F.lit(1))).otherwise(F.lit(0.0))
    return F.when(t <= 0, 0.0).when(t >= 1, 1.0).otherwise(t * t * (3 - 2 * t) if smooth else t)


def zoom(low: Column, high: Column, t: Column) -> Column:
    """Even steps from low to high, with exact ends."""
    return F.when(t <= 0, low).when(t >= 1, high).otherwise(low + (high - low) * t)


def not_rising(schedule: DataFrame, value: str = "zoom", order: str = "frame_index") -> DataFrame:
    """Frames whose value isn't above that of the frame before; a schedule of zooms has none. Schedules are small: one task orders them."""
    before = F.lag(value).over(Window.partitionBy(F.lit(1)).orderBy(order))
    return schedule.withColumn("before", before).where(F.col(value) <= F.col("before")).select(order, "before", value)


def crossfade(local: Column, lens_index: Column, length: int, hard: bool = False) -> Column:
    """The share of the new lens in the first `length` frames after a change, from 0 to 1; 1 elsewhere, and everywhere if the change is hard or takes one frame."""
    if hard or length <= 1:
        return F.lit(1.0)
    return F.when((lens_index > 0) & (local < length), local / F.lit(float(length - 1))).otherwise(F.lit(1.0))


def jump_frame(position: Column, count: Column) -> Column:
    """The frame of a jump at a share of the schedule; halves go to the even frame."""
    return F.rint(position * (count - 1)).cast("long")


def jump_progress(local: Column, count: Column, strength: Column, position: Column, transition: int) -> Column:
    """How much of a lens's exposure jump is in force: none before its frame, then evenly more over `transition` frames (or those that are left), then all. No strength, no jump."""
    at = jump_frame(position, count)
    ramp = F.lit(1.0) if transition == 0 else F.least(F.lit(1.0), (local - at + 1) / F.least(F.lit(transition), count - at))
    return F.when((strength == 0) | (local < at), 0.0).otherwise(ramp)


def jump_state(progress: Column, strength: Column, most_ev: float, noise: Column | None = None, noise_per_ev: float = 0.0) -> dict[str, Column]:
    """What a jump in progress does: its exposure in stops, the part applied, the gain, and, with a deviation of noise, the noise that goes with the gain."""
    applied = strength * most_ev * progress
    out = {"jump_ev": strength * most_ev, "applied_ev": applied, "gain": F.pow(F.lit(2.0), applied), "applied": (progress > 0) & (strength != 0)}
    return out | ({"noise_std": noise * F.greatest(F.lit(0.0), 1 + applied * noise_per_ev)} if noise is not None else {})


def guarded(original: Column, values: Column, least: float = 0.04, share: float = 0.6) -> Column:
    """A sequence in which each value keeps a least distance from the (changed) one before it: `least`, or a share of the distance between the originals, in their direction (if they are equal in that of the values, else upwards). A fold, as each depends on the last result."""
    pairs = F.arrays_zip(original.alias("o"), values.alias("v"))
    start = F.struct(F.array().cast("array<double>").alias("out"), F.lit(None).cast("double").alias("before"))

    def step(acc, p):
        last = F.element_at(acc["out"], -1)
        wanted, found = p["o"] - acc["before"], p["v"] - last
        way = F.when(wanted != 0, F.signum(wanted)).when(found != 0, F.signum(found)).otherwise(F.lit(1.0))
        most = F.greatest(F.lit(least), F.abs(wanted) * share)
        value = F.when(acc["before"].isNull(), p["v"]).when(found * way < most, last + way * most).otherwise(p["v"])
        return F.struct(F.concat(acc["out"], F.array(value)).alias("out"), p["o"].alias("before"))

    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def first_fitting(fits, steps: int = 12) -> Column:
    """The largest of 1, 1/2, 1/4 ... (`steps` of them) for which fits(scale) holds, else 0."""
    scales = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: F.pow(F.lit(2.0), -i))
    return F.coalesce(F.get(F.filter(scales, fits), 0), F.lit(0.0))


def plan(positions: DataFrame, lenses: DataFrame) -> DataFrame:
    """Every position with every lens, numbered lens by lens so that a prefix of the plan spreads over positions. Lenses are few: a checked broadcast."""
    n = lenses.count()
    if n > 10_000:
        raise ValueError("a plan of over 10,000 lenses isn't meant")
    both = positions.join(F.broadcast(lenses), F.lit(True))
    return both


def numbers(spark: SparkSession, n: int, name: str = "i") -> DataFrame:
    return spark.range(n).withColumnRenamed("id", name)
