"""Exact quantiles without a task that gets all values of a group.

A sketch of each group cuts its values into ranges of about equal counts. Counting the ranges, with partial sums, tells
in which of them each wanted rank lies; only the values of those ranges go on, and equal ones as one row. So a group may
have any number of rows: a task gets the values of one range of one group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import Z95

#: Ranges of a group; a power of two.
RANGES = 256

#: What the summary holds beside its plain aggregates.
POINTS = {"median": 0.5, "p10": 0.1, "p25": 0.25, "p75": 0.75, "p90": 0.9, "p95": 0.95}


def _group(groups: list[str]) -> Column:
    """The groups as one value, in which nulls are equal."""
    return F.struct(*(F.col(g) for g in groups)) if groups else F.struct(F.lit(1).alias("all"))


def quantiles(df: DataFrame, groups: list[str], wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """For each group, the quantiles named by `wanted` (of a column, at a share from 0 to 1), between the two nearest values in proportion. Nulls and NaN don't count; a column without values gives null. One row for each group; without groups one in all, if there are values."""
    columns: list[Column] = []
    of: dict[str, int] = {}
    for name, (column, _) in wanted.items():
        same = next((i for i, c in enumerate(columns) if c is column), None)
        of[name] = len(columns) if same is None else same
        if same is None:
            columns.append(column)
    g = df.select(*groups, _group(groups).alias("__g"), F.array(*(F.struct(F.lit(i).alias("__i"), c.cast("double").alias("__v")) for i, c in enumerate(columns))).alias("__all"))
    values = g.select("__g", F.inline("__all")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    sketch = values.groupBy("__g", "__i").agg(F.percentile_approx("__v", [k / RANGES for k in range(1, RANGES)], 20 * RANGES).alias("__cuts"), F.count(F.lit(1)).alias("__total"))
    steps = F.array(*(F.lit(RANGES >> k) for k in range(1, RANGES.bit_length())))
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("__cuts", at + step - 1) < F.col("__v"), at + step).otherwise(at))
    ranged = values.join(sketch, ["__g", "__i"]).select("__g", "__i", "__v", "__total", place.alias("__range"))
    ranges = ranged.groupBy("__g", "__i", "__range").agg(F.count(F.lit(1)).alias("__n"), F.first("__total").alias("__total"))
    before = F.sum("__n").over(Window.partitionBy("__g", "__i").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))  # RANGES rows at most
    shares = {i: sorted({p for name, (_, p) in wanted.items() if of[name] == i}) for i in range(len(columns))}
    by_column = F.create_map(*(x for i, ps in shares.items() for x in (F.lit(i), F.array(*map(F.lit, ps)))))
    at = ranges.withColumn("__before", F.coalesce(before, F.lit(0))).select("*", F.explode(by_column[F.col("__i")]).alias("__p"))
    exact = F.col("__p") * (F.col("__total") - 1)
    ends = F.array_distinct(F.array(F.floor(exact), F.least(F.floor(exact) + 1, F.col("__total") - 1)))
    ranks = at.select("__g", "__i", "__range", "__before", "__n", "__p", F.explode(ends).alias("__rank"), exact.alias("__exact")).where("__rank >= __before AND __rank < __before + __n")
    some = ranged.join(ranks.select("__g", "__i", "__range").distinct(), ["__g", "__i", "__range"], "left_semi").groupBy("__g", "__i", "__range", "__v").agg(F.count(F.lit(1)).alias("__n"))
    through = F.sum("__n").over(Window.partitionBy("__g", "__i", "__range").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    found = some.withColumn("__through", through).withColumnRenamed("__n", "__same").join(ranks.select("__g", "__i", "__range", "__before", "__p", "__rank", "__exact"), ["__g", "__i", "__range"])
    found = found.where("__rank < __before + __through AND __rank >= __before + __through - __same")
    low, high = F.min_by("__v", "__rank"), F.max_by("__v", "__rank")
    points = found.groupBy("__g", "__i", "__p").agg((low + (high - low) * (F.max("__exact") - F.min("__rank"))).alias("__q"))
    out = points.groupBy("__g").agg(*(F.max(F.when((F.col("__i") == of[name]) & (F.col("__p") == p), F.col("__q"))).alias(name) for name, (_, p) in wanted.items()))
    return out.select(*(F.col(f"__g.{x}").alias(x) for x in groups), *wanted)


def with_quantiles(aggregated: DataFrame, df: DataFrame, groups: list[str], wanted: dict[str, tuple[Column, float]]) -> DataFrame:
    """Adds quantiles over the rows `df` to a table with one row for each of its groups."""
    q = quantiles(df, groups, wanted)
    if not groups:
        return aggregated.join(F.broadcast(q), F.lit(True), "left")  # one row
    named = q.select(*(F.col(x).alias(f"__{x}") for x in groups), *wanted)
    return aggregated.join(named, reduce(Column.__and__, (F.col(x).eqNullSafe(F.col(f"__{x}")) for x in groups)), "left").drop(*(f"__{x}" for x in groups))


def summary(df: DataFrame, groups: list[str], x: Column, *also: Column) -> DataFrame:
    """The twelve-number summary of x by group: count, mean, median, population deviation, least, tails and quartiles, most, and a 95 % interval of the mean; and other aggregates.

    Nulls don't count. Without values the count is 0 and all else null; with one value there is no interval.
    """
    rows = df.withColumn("__x", x)
    x = F.col("__x")
    n, mean, half = F.count(x), F.avg(x), F.stddev_samp(x) / F.sqrt(F.nullif(F.count(x).cast("double"), F.lit(0.0))) * Z95
    several = F.when(n > 1, half)
    plain = {"count": n, "mean": mean, "stddev": F.stddev_pop(x), "min": F.min(x), "max": F.max(x), "ci_low": mean - several, "ci_high": mean + several}
    by = rows.groupBy(*groups).agg(*(v.alias(k) for k, v in plain.items()), *also)
    added = [c for c in by.columns if c not in groups and c not in plain]
    order = [*groups, "count", "mean", "median", "stddev", "min", "p10", "p25", "p75", "p90", "p95", "max", "ci_low", "ci_high", *added]
    return with_quantiles(by, rows, groups, {k: (x, p) for k, p in POINTS.items()}).select(*order)
