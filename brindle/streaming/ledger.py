"""Ledgers as streams: roll-ups, deduplication across restarts, running top k."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def tail(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", glob: str = "*") -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.format(kind).schema(schema).option("pathGlobFilter", glob).load(folder)


def drain(stream: DataFrame, folder: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over all that is there now and returns its result as a table, which is in the folder beside the stream's checkpoint. With the same folder the next call goes on where this one ended.

    The result of mode complete is that of the last batch; of the others, the rows of all batches. A batch that is run
    again after a failure replaces what it had written. The driver gets no rows.
    """
    spark, result = stream.sparkSession, f"{folder}/result"

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{result}/batch={0 if mode == 'complete' else number}")

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    if not any(x.isDirectory() for x in _listed(spark, result)):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(result).select(*stream.columns)


def _listed(spark: SparkSession, folder: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(files.listStatus(path)) if files.exists(path) else []


def roll_up(stream: DataFrame, keys: list[str], once: list[str], time: str | None = None, late: str = "1 day", **measures) -> DataFrame:
    """Aggregates by key over entries that count once for each value of `once`, also after a restart. With a time column, an entry is only recognised again for as long as `late`, and the state doesn't grow beyond that; without one it keeps all values of `once`."""
    if time:
        return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(once).groupBy(*keys).agg(*[v.alias(k) for k, v in measures.items()])
    return stream.dropDuplicates(once).groupBy(*keys).agg(*[v.alias(k) for k, v in measures.items()])


def windowed(stream: DataFrame, time: str, length: str, late: str, keys: list[str], **measures) -> DataFrame:
    """Aggregates by time window and key; entries later than `late` are dropped. An extra: ledgers have no event time."""
    return stream.withWatermark(time, late).groupBy(F.window(time, length), *keys).agg(*[v.alias(k) for k, v in measures.items()])


def running_top(stream: DataFrame, key: str, value: str, tie: str, k: int) -> DataFrame:
    """Each key's k best (value, smaller tie first) so far, given again whenever the key gets entries. The state is k rows for each key."""

    def update(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = list(zip(*state.get, strict=True)) if state.exists else []
        for rows in batches:
            best = sorted([*best, *zip(rows[value].astype(float), rows[tie].astype("int64"), strict=True)], key=lambda x: (-x[0], x[1]))[:k]
        state.update(([float(v) for v, _ in best], [int(t) for _, t in best]))
        yield pd.DataFrame({key: [name[0]] * len(best), "rank": range(1, len(best) + 1), value: [v for v, _ in best], tie: [t for _, t in best]})

    kind = dict(stream.dtypes)[key]
    schema = f"`{key}` {kind}, rank int, `{value}` double, `{tie}` long"
    return stream.groupBy(key).applyInPandasWithState(update, schema, "v array<double>, t array<long>", "update", GroupStateTimeout.NoTimeout)


def idle_passes(stream: DataFrame, key: str, order: str, completed: str) -> DataFrame:
    """How many polls in a row, for each key, saw no progress: the number grows until `completed` changes. Polls of one batch are taken in order."""

    def update(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, idle = state.get if state.exists else (-1, 0)
        rows = pd.concat(list(batches)).sort_values(order, kind="stable")
        out = []
        for at, done in zip(rows[order], rows[completed], strict=True):
            idle = idle + 1 if int(done) == seen else 0
            seen = int(done)
            out.append((name[0], at, seen, idle))
        state.update((seen, idle))
        yield pd.DataFrame(out, columns=[key, order, completed, "idle"])

    kinds = dict(stream.dtypes)
    return stream.groupBy(key).applyInPandasWithState(update, f"`{key}` {kinds[key]}, `{order}` {kinds[order]}, `{completed}` long, idle int", "seen long, idle int", "append", GroupStateTimeout.NoTimeout)
