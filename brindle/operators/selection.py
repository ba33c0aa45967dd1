"""Selection that stops early: candidates come in a fixed order, and what comes after the stop was never tried.

The running counts need one order over all candidates of a group, so a group is a task's work; give `groups` wherever
candidates have scenes. Without groups the window would be one task: candidate pools are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _running(groups: list[str], order: list[Column]):
    return (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(1))).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def attempted(df: DataFrame, order: list[Column], scored: Column, qualified: Column, k: int, budget: int, groups: list[str] | None = None) -> DataFrame:
    """The rows up to the one with which k have qualified or `budget` have been scored, with `running_scored` and `running_qualified`. Rows that aren't scored use up neither."""
    w = _running(groups or [], order)
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long")).over(w)
    rows = df.withColumn("running_scored", count(scored)).withColumn("running_qualified", count(qualified))
    before_scored = F.col("running_scored") - F.coalesce(scored, F.lit(False)).cast("long")
    before_qualified = F.col("running_qualified") - F.coalesce(qualified, F.lit(False)).cast("long")
    return rows.where((before_scored < budget) & (before_qualified < k))


def outcome(tried: DataFrame, k: int, budget: int, groups: list[str] | None = None, pool: DataFrame | None = None) -> DataFrame:
    """Why the search stopped. Enough results come first, then the end of the candidates, then that of the budget.

    pool: all candidates, of which `tried` are those that were looked at; it tells whether the last of them was the last
    of all, whatever the budget. Without it, a search that used up its budget counts as ended by it.
    """
    keys = groups or []
    by = tried.groupBy(*keys).agg(F.count(F.lit(1)).alias("attempted"), F.max("running_scored").alias("scored"), F.max("running_qualified").alias("qualified"))
    ended = F.col("scored") < budget
    if pool is not None:
        sizes = pool.groupBy(*keys).agg(F.count(F.lit(1)).alias("__pool"))
        by = by.join(sizes, keys) if keys else by.join(F.broadcast(sizes), F.lit(True))
        ended = F.col("attempted") >= F.col("__pool")
    reason = F.when(F.col("qualified") >= k, "threshold_complete").when(ended, "candidate_pool_exhausted").otherwise("score_budget_exhausted")
    return by.withColumn("reason", reason).withColumn("fallback", F.col("qualified") < k).drop("__pool")


def accept_until(df: DataFrame, order: list[Column], accept: Column, k: int, groups: list[str] | None = None) -> DataFrame:
    """The first k rows that are accepted, with their `accepted_rank`."""
    w = _running(groups or [], order)
    ranked = df.withColumn("accepted_rank", F.sum(F.coalesce(accept, F.lit(False)).cast("long")).over(w))
    return ranked.where(F.coalesce(accept, F.lit(False)) & (F.col("accepted_rank") <= k))


def apportion(df: DataFrame, groups: list[str], weight: str, tie: str, total: int) -> DataFrame:
    """Largest-remainder shares of `total` by weight; ties go to the smaller tie value. If all weights are 0 they count as equal. Adds `share` long; see `unserved`."""
    over = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(1))
    even = F.max(F.abs(F.col(weight))).over(over) == 0
    exact = F.when(even, F.lit(1.0)).otherwise(F.col(weight)) * total / F.when(even, F.count(F.lit(1)).over(over).cast("double")).otherwise(F.sum(weight).over(over))
    rows = df.withColumn("__exact", exact).withColumn("__floor", F.floor("__exact").cast("long"))
    rows = rows.withColumn("__left", F.lit(total) - F.sum("__floor").over(over))
    nth = F.row_number().over(over.orderBy(F.desc(F.round(F.col("__exact") - F.col("__floor"), 9)), tie))
    return rows.withColumn("share", F.col("__floor") + F.when(nth <= F.col("__left"), 1).otherwise(0)).drop("__exact", "__floor", "__left")


def unserved(shares: DataFrame) -> DataFrame:
    """Rows that got no share at all, where each needs one: the total is too small."""
    return shares.where("share < 1")


def too_few(accepted: DataFrame, pool: DataFrame, k: int, groups: list[str]) -> DataFrame:
    """Groups of the pool in which fewer than k rows were accepted, with how many."""
    n = accepted.groupBy(*groups).agg(F.count(F.lit(1)).alias("accepted"))
    return pool.select(*groups).distinct().join(n, groups, "left").select(*groups, F.coalesce("accepted", F.lit(0)).alias("accepted")).where(F.col("accepted") < k)
