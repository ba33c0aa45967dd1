"""Best rows, ranks and samples. Every order has a tie-break, so results don't depend on how rows are dealt out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import natural_key
from ..session import checkpointed


def best_per_group(df: DataFrame, groups: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first k rows of each group. Spark limits groups before the shuffle, so a hot group sends k rows from each task."""
    numbered = df.withColumn("__n", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
    return numbered.where(F.col("__n") <= k).drop("__n")


def rank_all(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Ranks 1 to n over all rows, without a task that gets them all.

    Rows are range-partitioned and sorted; each partition's size is known after one pass, so every row's rank is the
    rows before its partition plus its place in it. `order` must decide every tie.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    part, place = F.shiftright("__at", 33).cast("int"), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = checkpointed(placed.withColumn("__part", part).withColumn("__place", place).drop("__at"))
    sizes = placed.groupBy("__part").count().orderBy("__part").collect()  # one number for each partition
    before, total = [], 0
    for r in sizes:
        before.append((r[0], total))
        total += r[1]
    starts = df.sparkSession.createDataFrame(before, "__part int, __start long")
    return placed.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__place") + 1).select(*df.columns, name)


def top_k(df: DataFrame, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows, ranked. Each task keeps k rows; k rows are numbered at the end."""
    return df.orderBy(*order).limit(k).withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))


def drop_excess(df: DataFrame, measure: Column, most: float, nan_stays: bool) -> DataFrame:
    """Rows whose measure is at most `most`. A NaN is above every number in SQL, but not by comparison in most languages: nan_stays tells which."""
    return df.where((F.isnan(measure) | (measure <= most)) if nan_stays else (~F.isnan(measure) & (measure <= most)))


def natural_order(df: DataFrame, name: str, tie: str, to: str = "position") -> DataFrame:
    return rank_all(df.withColumn("__key", natural_key(F.col(name))), [F.col("__key"), F.col(tie)], to).drop("__key")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Sizes of two key sets' intersection and union, and their Jaccard similarity (null if both are empty)."""
    both = a.select(key).distinct().withColumn("a", F.lit(1)).join(b.select(key).distinct().withColumn("b", F.lit(1)), key, "full_outer")
    common, union = F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()), F.count(F.lit(1))
    return both.agg(common.alias("common"), union.alias("union_size"), (common.cast("double") / F.nullif(union, F.lit(0))).alias("jaccard"))


def gap_to_next(df: DataFrame, groups: list[str], loss: str, tie: str, margin: float) -> DataFrame:
    """Each group's best row by falling loss, the gap to the second, and whether that is within the margin."""
    order = Window.partitionBy(*groups).orderBy(loss, tie)
    rows = df.withColumn("__n", F.row_number().over(order)).withColumn("second", F.lead(loss).over(order)).where("__n = 1").drop("__n")
    return rows.withColumn("gap", F.col("second") - F.col(loss)).withColumn("ambiguous", F.coalesce(F.col("gap") <= margin, F.lit(False)))


def sample_k(df: DataFrame, key: Column, k: int, seed: int = 0) -> DataFrame:
    """k rows without replacement: those with the least hash of seed and key. Samples of parts merge to the sample of the whole."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(k)


def coarse_to_fine(df: DataFrame, groups: list[str], loss: Column, refined: Column, tie: str, k: int) -> DataFrame:
    """The k rows of each group with the least loss, with a better measure `refined` that is only taken of these, and their `place` by it."""
    best = best_per_group(df, groups, [loss, F.col(tie)], k).withColumn("refined", refined)
    return best.withColumn("place", F.row_number().over(Window.partitionBy(*groups).orderBy("refined", tie)).cast("long"))


def ambiguous(gap: Column, best_loss: Column, margin: float, least_similarity: float) -> Column:
    """Is a best row not clearly the best: the next one is within the margin, or it isn't similar enough itself?"""
    return F.coalesce(gap <= margin, F.lit(False)) | (1 / (1 + best_loss) < least_similarity)
