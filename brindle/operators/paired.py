"""Paired comparison of two strategies over the same candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import mcnemar_exact, ratio, wilson
from .quantiles import summary, with_quantiles


def pair(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row for each key that both sides have, with a_<column> and b_<column>. Keys are unique on either side."""
    side = lambda df, p: df.select(*keys, *[F.col(c).alias(f"{p}_{c}") for c in columns])
    return side(a, "a").join(side(b, "b"), keys)


def pair_grouped(df: DataFrame, keys: list[str], strategy: Column, a: str, b: str, **measures: Column) -> DataFrame:
    """As `pair`, for two strategies in one table with any number of rows: measures are aggregates over each strategy's rows. One shuffle by key serves both strategies."""
    marked = df.withColumn("__strategy", strategy).where(F.col("__strategy").isin(a, b))
    per = marked.groupBy(*keys, "__strategy").agg(*[v.alias(k) for k, v in measures.items()])
    pick = lambda s, p: [F.max(F.when(F.col("__strategy") == s, F.col(k))).alias(f"{p}_{k}") for k in measures]
    both = per.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *pick(a, "a"), *pick(b, "b"))
    return both.where("__n = 2").drop("__n")


def contingency(pairs: DataFrame, a_pass: Column, b_pass: Column, groups: list[str] | None = None) -> DataFrame:
    """Counts of both, only a, only b and neither, the pass rates with Wilson intervals, their difference, and McNemar's exact p-value."""
    n = F.count_if
    counts = pairs.groupBy(*(groups or [])).agg(
        F.count(F.lit(1)).alias("pairs"), n(a_pass & b_pass).alias("both"), n(a_pass & ~b_pass).alias("only_a"), n(~a_pass & b_pass).alias("only_b"), n(~a_pass & ~b_pass).alias("neither")
    )
    a, b, total = F.col("both") + F.col("only_a"), F.col("both") + F.col("only_b"), F.col("pairs")
    (a_low, a_high), (b_low, b_high) = wilson(a, total), wilson(b, total)
    extra = {"rate_a": ratio(a, total), "a_low": a_low, "a_high": a_high, "rate_b": ratio(b, total), "b_low": b_low, "b_high": b_high, "rate_delta": ratio(b, total) - ratio(a, total), "p_value": mcnemar_exact(F.col("only_a"), F.col("only_b"))}
    return counts.select("*", *[v.alias(k) for k, v in extra.items()])


def delta_summary(pairs: DataFrame, a: Column, b: Column, tolerance: float = 1e-12, groups: list[str] | None = None) -> DataFrame:
    """The summary of b - a over pairs that have both, and how often b is higher, level within the tolerance, or lower."""
    d = F.col("__d")
    counts = F.count_if(d > tolerance).alias("higher"), F.count_if(F.abs(d) <= tolerance).alias("level"), F.count_if(d < -tolerance).alias("lower")
    return summary(pairs.withColumn("__d", b - a), groups or [], d, *counts)


def rates(passes: Column, candidates: Column, seconds: Column) -> dict[str, Column]:
    """Passes for each thousand candidates and each hour of work, and seconds for each pass; null where the divisor is 0."""
    return {"per_thousand": ratio(passes * 1000, candidates), "per_hour": ratio(passes * 3600, seconds), "seconds_per_pass": ratio(seconds, passes)}


def pooled(df: DataFrame, group: str, strategy: str, aggregates: list[Column], points: dict[str, tuple[Column, float]] | None = None) -> DataFrame:
    """Aggregates, and quantiles, for each (group, strategy), and for each strategy over the raw rows of all groups (group null). Pooled quantiles come from rows, not from averages."""
    out = []
    for keys in ([group, strategy], [strategy]):
        by = df.groupBy(*keys).agg(*aggregates)
        out.append(with_quantiles(by, df, keys, points) if points else by)
    return out[0].unionByName(out[1], allowMissingColumns=True)
