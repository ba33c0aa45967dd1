"""Sessions and tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "brindle", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A session on this machine, for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _checkpoints(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only on one machine, where it is unset, a folder is made here."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if not named and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="brindle-checkpoint-"))
    return named or context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions whenever they are read again, even if an executor is lost: written to the shared folder."""
    _checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The same rows whenever they are read again, by a table in the shared folder; their partitions aren't kept. Its size is known from its files, so joins are planned by it."""
    folder = f"{_checkpoints(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
