"""Append-only ledgers: last entry wins, resume, reconciliation, contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last entry of each key. Aggregated before the shuffle, so a key that is written again and again costs one row for each task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, "__row.*").select(*df.columns)


def remaining(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is left to do after a restart."""
    return plan.join(done.select(*keys), keys, "left_anti")


def reconcile(expected: DataFrame, found: DataFrame, keys: list[str], expected_keys: list[str] | None = None) -> DataFrame:
    """Keys that are missing or unexpected, with their `side`. No rows: the key sets are equal."""
    a = expected.select(*[F.col(x).alias(k) for x, k in zip(expected_keys or keys, keys, strict=True)]).distinct()
    b = found.select(*keys).distinct()
    both = a.withColumn("__a", F.lit(1)).join(b.withColumn("__b", F.lit(1)), keys, "full_outer")
    return both.where("__a IS NULL OR __b IS NULL").select(*keys, F.when(F.col("__b").isNull(), "missing").otherwise("unexpected").alias("side"))


def orphans(child: DataFrame, parent: DataFrame, foreign: str, primary: str) -> DataFrame:
    """Rows whose foreign key names no row, or is null."""
    return child.join(parent.select(F.col(primary).alias(foreign)), foreign, "left_anti")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def completeness(df: DataFrame, key: str, first: Column, second: Column) -> DataFrame:
    """Does each key have both kinds of row, one or neither?"""
    by = df.groupBy(key).agg(F.bool_or(first).alias("has_first"), F.bool_or(second).alias("has_second"))
    state = F.when(F.col("has_first") & F.col("has_second"), "both").when(F.col("has_first") | F.col("has_second"), "partial").otherwise("neither")
    return by.withColumn("state", state)


def violations(df: DataFrame, rules: dict[str, Column], key: list[str]) -> DataFrame:
    """A row for each key and rule that isn't true. A rule that comes out null is broken; say so in the rule if null is fine."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]), lambda x: x.isNotNull())
    return df.select(*key, F.explode(broken).alias("rule"))


def violation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row for each rule, with how many rows break it; one pass over the rows."""
    counts = df.agg(*[F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()])
    return counts.unpivot([], list(rules), "rule", "broken") if rules else counts


def agree(a: DataFrame, b: DataFrame, on: list[str], compare: list[str], tolerance: float | None = 0.0) -> DataFrame:
    """A row for each key and column in which two tables differ; keys of one table alone differ in all. Nulls are equal to nulls. Without a tolerance, columns may be of any type."""
    near = lambda c: F.lit(False) if tolerance is None else F.coalesce(F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) <= tolerance, F.lit(False))
    differs = lambda c: ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) & ~near(c)
    both = a.select(*on, *[F.col(c).alias(f"a_{c}") for c in compare]).join(b.select(*on, *[F.col(c).alias(f"b_{c}") for c in compare]), on, "full_outer")
    broken = F.filter(F.array(*[F.when(differs(c), F.lit(c)) for c in compare]), lambda x: x.isNotNull())
    return both.select(*on, F.explode(broken).alias("column"))


def islands(df: DataFrame, groups: list[str], order: list[Column], changed: Column) -> DataFrame:
    """Numbers runs of rows within each group; a row for which `changed` holds begins a new run."""
    from pyspark.sql import Window

    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("__c", F.coalesce(changed, F.lit(True)).cast("int")).withColumn("island", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__c")
