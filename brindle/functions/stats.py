"""Statistics as aggregate and scalar expressions. All are exact; none approximates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the two-sided 95 % normal quantile, to the two places that published intervals use.
Z95 = 1.96


def wilson(successes: Column, total: Column) -> tuple[Column, Column]:
    """The ends of Wilson's 95 % score interval; null for a total of 0."""
    n = F.nullif(total.cast("double"), F.lit(0.0))
    p = successes.cast("double") / n
    scale, centre = 1 + Z95 * Z95 / n, p + Z95 * Z95 / (2 * n)
    half = Z95 * F.sqrt(p * (1 - p) / n + Z95 * Z95 / (4 * n * n))
    low, high = F.greatest(F.lit(0.0), (centre - half) / scale), F.least(F.lit(1.0), (centre + half) / scale)
    return F.when(n.isNotNull(), low), F.when(n.isNotNull(), high)


def mcnemar_exact(only_a: Column, only_b: Column) -> Column:
    """The two-sided exact p-value of McNemar's test: both tails of a fair binomial over the discordant pairs; null if there are none.

    Logarithms of the binomial terms are summed one by one, so the work grows with the smaller count.
    """
    n, k = (only_a + only_b).cast("long"), F.least(only_a, only_b).cast("long")
    start = F.struct((-n * F.log(F.lit(2.0))).alias("term"), F.lit(0.0).alias("tail"))
    step = lambda acc, i: F.struct((acc["term"] + F.log((n - i + 1).cast("double")) - F.log(i.cast("double"))).alias("term"), acc["tail"])
    folded = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        start,
        lambda acc, i: F.when(i == 0, F.struct(acc["term"].alias("term"), F.exp(acc["term"]).alias("tail"))).otherwise(F.struct(step(acc, i)["term"].alias("term"), (acc["tail"] + F.exp(step(acc, i)["term"])).alias("tail"))),
        lambda acc: F.least(F.lit(1.0), 2 * acc["tail"]),
    )
    return F.when(n > 0, folded)


def close(a: Column, b: Column, relative: float = 1e-9, absolute: float = 0.0) -> Column:
    """Are two numbers equal within a tolerance?"""
    return F.abs(a - b) <= F.greatest(relative * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))


def finite(x: Column) -> Column:
    """False for null, NaN and infinities."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def ratio(a: Column, b: Column) -> Column:
    """a / b as doubles; null where b is 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def uniform(seed: int, *keys: Column) -> Column:
    """A number from [0, 1) that depends on the seed and the keys alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 52)) / float(1 << 52)
