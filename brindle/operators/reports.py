"""The measures by which strategies are compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import ratio, wilson
from .quantiles import summary


def distance_fraction(initial: Column, final: Column) -> Column:
    """What is left of the way to the centre; null for a way of no length."""
    return F.when(initial > 0, final / F.nullif(initial, F.lit(0.0)))


def range_retained(initial: Column, minimum: Column, final: Column) -> Column:
    """What is left of the way to the nearest allowed distance; null if there was hardly any."""
    available = initial - minimum
    return F.when(available > F.greatest(initial, F.lit(1.0)) * 1e-12, (final - minimum) / F.nullif(available, F.lit(0.0)))


def measures(target: float) -> dict[str, Column]:
    """Of an entry; null where a measure isn't taken of it."""
    c = F.col
    passed = lambda x: F.when(c("coverage_pass"), x)
    return {
        "final_pixel_ratio_all": c("ratio"), "final_pixel_ratio_passed": passed(c("ratio")), "overshoot_passed": passed(c("ratio") - target), "score": passed(c("score")),
        "initial_distance": c("initial"), "final_distance": c("final"), "pull_in_distance": c("initial") - c("final"), "final_over_initial": distance_fraction(c("initial"), c("final")),
        "pull_in_fraction": 1 - distance_fraction(c("initial"), c("final")), "range_retained": range_retained(c("initial"), c("minimum"), c("final")), "nearest_distance": c("nearest"),
        "preview_evaluations": c("preview"), "output_evaluations": c("output"), "evaluations": c("evaluations"),
        "fit_seconds": c("fit"), "render_seconds": c("render"), "render_seconds_scored": passed(c("render")), "total_seconds": c("total"),
    }


def strategy_measures(entries: DataFrame, groups: list[str], target: float) -> DataFrame:
    """The twelve-number summary of every measure, a row for each group and measure. One pass melts the entries; quantiles need no task for a whole group."""
    rows = F.array(*[F.struct(F.lit(k).alias("measure"), v.cast("double").alias("value")) for k, v in measures(target).items()])
    return summary(entries.select(*groups, F.inline(rows)), [*groups, "measure"], F.col("value"))


def strategy_rates(entries: DataFrame, groups: list[str], threshold: float) -> DataFrame:
    """Counts, rates, sums and efficiencies of each group; null where the divisor is 0."""
    passed, score = F.col("coverage_pass"), F.col("score")
    by = entries.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(passed).alias("coverage_passes"), F.count(F.when(passed, score)).alias("scores"), F.count_if(passed & (score > threshold)).alias("threshold_passes"),
        F.sum("evaluations").cast("long").alias("evaluations"), F.sum("fit").alias("fit_seconds"), F.sum("render").alias("render_seconds"), F.sum("total").alias("total_seconds"),
    )
    n, k, s, t, sec = (F.col(x) for x in ("candidates", "coverage_passes", "scores", "threshold_passes", "total_seconds"))
    low, high = wilson(k, n)
    each_hour = lambda x: F.when(sec > 0, ratio(x * 3600, sec))
    more = {
        "coverage_rate": ratio(k, n), "coverage_low": low, "coverage_high": high, "threshold_rate": ratio(t, n), "threshold_rate_of_scored": ratio(t, s),
        "coverage_per_thousand": ratio(k * 1000, n), "threshold_per_thousand": ratio(t * 1000, n), "candidates_per_hour": each_hour(n), "coverage_per_hour": each_hour(k), "threshold_per_hour": each_hour(t), "seconds_per_threshold_pass": ratio(sec, t),
    }
    return by.select("*", *[v.alias(k) for k, v in more.items()])


def overlap_deltas(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """b's value less a's, of the keys that both top lists hold."""
    return a.select(key, F.col(value).alias("__a")).join(b.select(key, F.col(value).alias("__b")), key).select(key, (F.col("__b") - F.col("__a")).alias("delta"))


def hinge(lacking: Column) -> Column:
    """What is lacking, if anything is."""
    return F.greatest(lacking, F.lit(0.0))


def coverage_objective(coverage: Column, background: Column, least_coverage: float, most_background: float, target: float = 1.0) -> Column:
    """How far an image is from the coverage that is wanted; what misses the limits counts twice."""
    return F.abs(F.lit(target) - coverage) + 2 * hinge(F.lit(least_coverage) - coverage) + 2 * hinge(background - most_background)


def with_default(groups: DataFrame, found: DataFrame, on: list[str], **defaults) -> DataFrame:
    """A row for every group: those that have no metrics get the defaults."""
    rows = groups.select(*on).distinct().join(found, on, "left")
    return rows.select(*on, *[F.coalesce(F.col(c), F.lit(v)).alias(c) if v is not None else F.col(c) for c, v in {c: defaults.get(c) for c in found.columns if c not in on}.items()])


def capture_document(threshold: float, least_coverage: float) -> Column:
    """An entry as a nested document: what was tried, what was found, and whether it passes; without a score its part is null, and it isn't accepted."""
    c = F.col
    passes = F.coalesce(c("score") > threshold, F.lit(False))
    quality = F.when(c("score").isNotNull(), F.struct(c("score"), passes.alias("passes")))
    return F.struct(
        F.struct(c("candidate_index").alias("index"), c("strategy")).alias("candidate"),
        F.struct(c("ratio"), (c("ratio") >= least_coverage).alias("constraints_met"), F.struct(c("preview"), c("output"), c("evaluations").alias("total")).alias("evaluations")).alias("coverage"),
        quality.alias("image_quality"),
        (c("coverage_pass") & passes).alias("accepted"),
    )
