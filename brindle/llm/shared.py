"""What the operators of this subpackage have in common."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir, which all executors share. Only where the setting is unset on one machine, as in tests, one is made here; a cluster without it is an error."""
    context = spark.sparkContext
    if named := context.getConf().get("spark.checkpoint.dir"):
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="brindle-checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder and reads them from there: later steps see the same rows in the same partitions even if an executor is lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As `cut`, by a table in the shared folder, for what is cut again and again in a loop. A checkpoint remembers the estimated size of what it was made of, and that of a join is the product of its sides'; over some rounds these numbers grow until planning takes minutes and the driver's memory. A table's size is that of its files. Partitions aren't kept."""
    folder = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out._folder = folder
    return out


def discard(df: DataFrame) -> None:
    """Deletes the table of a `written` frame that nothing needs any more."""
    if folder := getattr(df, "_folder", None):
        delete(df.sparkSession, folder)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: No more than so many keys are ever heavy, as one has more than this part of all rows.
MOST_HEAVY = 1 << 16
LIGHT = 256


def heavy_keys(counts: DataFrame, total: int, light: int | None = None) -> list[tuple]:
    """Of counts (key columns, then `n`) of `total` rows in all: the keys of more than `light` rows (LIGHT by default) and more than a 65,536th of all, each with the number of parts, of about as many rows as the limit, to spread it over. So the driver gets MOST_HEAVY rows at the very most."""
    limit = max(LIGHT if light is None else light, -(-total // MOST_HEAVY))
    keys = [c for c in counts.columns if c != "n"]
    found = counts.where((F.col("n") > limit) & F.col(keys[-1]).isNotNull()).collect() if total > limit else []
    return [(*(r[c] for c in keys), -(-r["n"] // limit)) for r in found]


def join_spread(rows: DataFrame, one: DataFrame, key: str, heavy: list[tuple]) -> DataFrame:
    """Joins `rows`, of which a key may have any number, with `one`, where it has one row at most, on their column `key`. The rows of heavy keys (key, parts) are spread over tasks by their hash, and meet a copy of its row in each part. Keys that are null match nothing."""
    if not heavy:
        return rows.join(one, key)
    listed = F.broadcast(rows.sparkSession.createDataFrame(heavy, f"`{key}` {dict(rows.dtypes)[key]}, __parts int"))
    parts = F.coalesce("__parts", F.lit(1))
    spread = rows.join(listed, key, "left").withColumn("__part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), parts).cast("int")).drop("__parts")
    copied = one.join(listed, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return spread.join(copied, [key, "__part"]).drop("__part")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


class Cache(dict):
    """Results by string that can be made again, of at most most_bytes. When it is full, the older half is dropped; what is frequent is soon back."""

    def __init__(self, make: Callable, most_bytes: int):
        super().__init__()
        self.make, self.most, self.used = make, most_bytes, 0

    def __missing__(self, key: str):
        value = self.make(key)
        self.add({key: value})
        return value

    def add(self, found: dict) -> None:
        size = 260 * len(found) + sum(map(len, found)) + sum(len(x) * getattr(x, "itemsize", 1) for x in found.values())  # with Python's objects and the dictionary's places
        if self.used + size > self.most:
            for key in list(islice(self, len(self) // 2)):
                del self[key]
            self.used //= 2
        self.used += size
        self.update(found)


_releases: dict[str, Callable[[], None]] = {}
_holder = ""


def holds(owner: str, release: Callable[[], None]) -> None:
    """Registers how to give back what an operator keeps in a Python worker between tasks."""
    _releases[owner] = release


def claim(owner: str) -> None:
    """Called in a worker as a task of an operator begins. Spark uses workers again, for other operators too; what those have kept is given back then, so that a worker never holds the caches of two."""
    global _holder
    if owner != _holder:
        for name, release in _releases.items():
            if name != owner:
                release()
        if _holder:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library: it keeps what it has
                pass
        _holder = owner


def map_rows(df: DataFrame, rows: Callable[[pa.RecordBatch], list[pa.Array]], schema, names: list[str], most_bytes: int = 8 << 20, owner: str = "none") -> DataFrame:
    """mapInArrow by a function of one batch that returns columns. Batches are cut to pieces of a few MB first, so that long texts don't meet in one. owner: see `claim`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(owner)
        for batch in batches:
            for part in pieces(batch, most_bytes):
                yield pa.RecordBatch.from_arrays(rows(part), names=names)

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Halves a batch until each part has at most most_bytes, or one row."""
    if batch.num_rows > 1 and batch.nbytes > most_bytes:
        half = batch.num_rows // 2
        yield from pieces(batch.slice(0, half), most_bytes)
        yield from pieces(batch.slice(half), most_bytes)
    elif batch.num_rows:
        yield batch
