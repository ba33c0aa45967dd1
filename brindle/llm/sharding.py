"""A uniform random shuffle into shards of exact sizes, by a hypergeometric communication matrix.

If all rows are shuffled uniformly, the numbers of rows that go from each input partition to each cell of the output
follow a multivariate hypergeometric law. Here these numbers are drawn first; each partition then permutes its rows
locally and deals them out by its row of the matrix, and each cell permutes what it gets. The result is a uniform
permutation, and every size is exact.

The matrix is never held anywhere. Partitions are halved again and again, and each half's numbers are drawn from a
generator seeded by the half's bounds; a task follows the path to its own row. So a task needs the row counts of all
partitions (one number each) and one vector over cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: numpy draws from urns of fewer balls than this.
_URN = 1_000_000_000


def draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n balls drawn from an urn are good."""
    if good + bad < _URN:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    low, high, total = max(0, n - bad), min(n, good), good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    spread = int(14 * (n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5) + 40
    k = np.arange(max(low, mode - spread), min(high, mode + spread) + 1, dtype=np.float64)
    ratio = np.log(good - k[:-1]) + np.log(n - k[:-1]) - np.log(k[:-1] + 1) - np.log(bad - n + k[:-1] + 1)  # of each probability to the one before
    logs = np.concatenate([[0.0], np.cumsum(ratio)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return int(k[min(len(k) - 1, np.searchsorted(weights, rng.random() * weights[-1], side="right"))])


def draw_many(rng: np.random.Generator, colours: np.ndarray, n: int) -> np.ndarray:
    """How many balls of each colour are among n drawn."""
    total = int(colours.sum())
    if total < _URN:
        return rng.multivariate_hypergeometric(colours, n, method="marginals") if n else np.zeros_like(colours)
    if len(colours) == 1:
        return np.array([n], colours.dtype)
    half = len(colours) // 2
    left = draw(rng, int(colours[:half].sum()), int(colours[half:].sum()), n)
    return np.concatenate([draw_many(rng, colours[:half], left), draw_many(rng, colours[half:], n - left)])


def matrix_row(counts: np.ndarray, cells: np.ndarray, row: int, seed: int) -> np.ndarray:
    """How many rows partition `row` sends to each cell. counts: rows of each partition; cells: rows that each cell gets."""
    low, high, left = 0, len(counts), cells.astype(np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        first = draw_many(np.random.default_rng([seed, low, high]), left, int(counts[low:middle].sum()))
        low, high, left = (low, middle, first) if row < middle else (middle, high, left - first)
    return left


def shard(docs: DataFrame, shards: int = 24, seed: int = 7, cells_per_shard: int | None = None) -> DataFrame:
    """All rows with all columns, and `shard` int and `slot` long: a uniform random order, cut into shards whose sizes differ by one at most.

    Slots of a shard go from 0 without a gap. Input columns of these two names are dropped. What a row holds has no
    influence on its place, so nulls, repeated rows, long texts and hot keys need no care; an empty table gives an
    empty table. The partitions of `docs` must come out alike when they are computed again, as those of a table scan
    do; give other inputs by way of a checkpoint. A task whose number of rows has changed fails.

    A shard is made of cells_per_shard cells, each of which one task permutes; by default there are about twice as many
    cells as shuffle partitions, so no task gets a whole shard of a large table.
    """
    docs = docs.drop("shard", "slot", "__cell", "__key")
    counts = dict(docs.groupBy(F.spark_partition_id().alias("part")).count().collect())  # one number for each partition
    counts = np.array([counts.get(i, 0) for i in range(max(counts, default=-1) + 1)], np.int64)
    total, spark = int(counts.sum()), docs.sparkSession
    if cells_per_shard is None:
        wanted = -(-2 * int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
        cells_per_shard = max(1, min(wanted, total // shards // 64))
    k = cells_per_shard
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    cells = np.array([sizes[s] * (i + 1) // k - sizes[s] * i // k for s in range(shards) for i in range(k)], np.int64)
    shared = spark.sparkContext.broadcast((counts, cells))
    names = [*docs.columns, "__cell", "__key"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts, cells = shared.value
        part = TaskContext.get().partitionId()
        n = int(counts[part]) if part < len(counts) else 0
        rng = np.random.default_rng([seed, part, len(counts), 1])
        labels = np.repeat(np.arange(len(cells), dtype=np.int32), matrix_row(counts, cells, part, seed)) if n else np.zeros(0, np.int32)
        rng.shuffle(labels)
        at = 0
        for batch in batches:
            mine = labels[at : at + batch.num_rows]
            if len(mine) < batch.num_rows:
                raise RuntimeError(f"partition {part} had {n} rows when it was counted and now has more: checkpoint the input")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(mine), pa.array(rng.integers(1 << 62, size=len(mine)))], names=names)
            at += batch.num_rows
        if at != n:
            raise RuntimeError(f"partition {part} had {n} rows when it was counted and now has {at}: checkpoint the input")

    schema = docs.select("*", F.lit(0).alias("__cell"), F.lit(0).cast("long").alias("__key")).schema
    dealt = docs.mapInArrow(deal, schema)
    number = F.row_number().over(Window.partitionBy("__cell").orderBy("__key")).cast("long") - 1
    which = F.expr(f"__cell div {k}")
    size = F.lit(total // shards) + F.when(which < total % shards, 1).otherwise(0)
    first = F.floor(size * F.pmod("__cell", F.lit(k)) / k) if k == 1 else F.expr(f"({total // shards} + int(__cell div {k} < {total % shards})) * (__cell % {k}) div {k}")
    return dealt.select("*", which.cast("int").alias("shard"), (first.cast("long") + number).alias("slot")).drop("__cell", "__key")
