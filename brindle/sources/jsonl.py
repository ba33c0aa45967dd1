"""Append-only JSON lines, in a strict and a lenient mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stored


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file and its number there, from 0, and whether it is a last one without an end.

    A file is read in blocks, by as many tasks as it has blocks, and no task holds more than a line of it. The lines are
    stored once with their places in their blocks, and the blocks' counts give their places in the files. A file whose
    lines, with an end each, are a byte longer than itself has none after its last line.
    """
    place = [F.col(f"_metadata.{c}").alias(x) for c, x in (("file_path", "__path"), ("file_block_start", "__block"), ("file_size", "__size"))]
    kept = stored(spark.read.option("lineSep", "\n").text(path).select(*place, F.monotonically_increasing_id().alias("__at"), F.col("value").alias("line")))
    blocks = kept.groupBy("__path", "__block").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"), F.sum(F.octet_length("line") + F.lit(1)).alias("__bytes"), F.max("__size").alias("__size"))
    of_file = Window.partitionBy("__path")
    before = F.coalesce(F.sum("__n").over(of_file.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    over = F.sum("__bytes").over(of_file) - F.col("__size")  # 1 without a last end; less by 3 if the reader has left out a byte order mark
    name = F.regexp_replace(F.url_decode(F.replace("__path", F.lit("+"), F.lit("%2B"))), "^file:///", "file:/")
    blocks = stored(blocks.select("__path", "__block", name.alias("file"), (before - F.col("__first")).alias("__shift"), F.sum("__n").over(of_file).alias("__lines"), over.isin(1, -2).alias("__unended"), over.isin(-2, -3).alias("__marked")))
    number = F.col("__at") + F.col("__shift")
    rows = kept.join(blocks, ["__path", "__block"])
    line = F.when(F.col("__marked") & (number == 0), F.concat(F.lit("\ufeff"), "line")).otherwise(F.col("line"))
    return rows.select("file", number.alias("line_no"), line.alias("line"), (F.col("__unended") & (number == F.col("__lines") - 1)).alias("unended"))


def parsed(rows: DataFrame, schema: StructType | str) -> DataFrame:
    """Adds `entry` (null where the line is no JSON object) and `torn`: a last line that was cut off in the middle."""
    text = schema if isinstance(schema, str) else schema.simpleString()
    variant = F.try_parse_json("line")
    is_object = F.coalesce(F.startswith(F.schema_of_variant(variant), F.lit("OBJECT")), F.lit(False))
    return rows.withColumn("entry", F.when(is_object, F.from_json("line", text))).withColumn("torn", F.col("unended") & F.col("entry").isNull())


def read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All whole entries as columns beside file and line_no. A torn last line is left out; any other bad or blank line is an error when the rows are read."""
    rows = parsed(lines(spark, path), schema).where(~F.col("torn"))
    entry = F.when(F.col("entry").isNull(), F.raise_error(F.concat(F.lit("bad line "), F.col("line_no").cast("string"), F.lit(" in "), F.col("file")))).otherwise(F.col("entry"))
    return rows.select("file", "line_no", entry.alias("entry")).select("file", "line_no", "entry.*")


def read_lenient(spark: SparkSession, path: str, schema: StructType | str, keys: list[str], known: Column) -> DataFrame:
    """Blank lines and entries for which `known` doesn't hold are skipped; of entries with the same keys the last one in a file counts. Other bad lines are errors."""
    rows = parsed(lines(spark, path), schema).where(~F.col("torn") & (F.trim("line") != ""))
    entry = F.when(F.col("entry").isNull(), F.raise_error(F.concat(F.lit("bad line "), F.col("line_no").cast("string")))).otherwise(F.col("entry"))
    rows = rows.select("file", "line_no", entry.alias("entry")).select("file", "line_no", "entry.*").where(known)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("file"), F.desc("line_no")))
    return rows.withColumn("__n", last).where("__n = 1").drop("__n")


def problems(spark: SparkSession, path: str, schema: StructType | str, keys: list[str], allowed: dict[str, list[str]]) -> DataFrame:
    """What strict reading objects to: (file, line_no, problem) for blank and bad lines, values that aren't allowed, and keys that repeat."""
    rows = parsed(lines(spark, path), schema)
    e = F.col("entry")
    n = F.count(F.lit(1)).over(Window.partitionBy(*[e[k] for k in keys]))
    rules = [F.when(F.trim("line") == "", F.lit("blank")), F.when((F.trim("line") != "") & e.isNull() & ~F.col("torn"), F.lit("bad json")), F.when(F.col("torn"), F.lit("torn tail"))]
    rules += [F.when(e.isNotNull() & ~F.coalesce(e[c].isin(v), F.lit(False)), F.lit(f"unknown {c}")) for c, v in allowed.items()]
    rules += [F.when(e.isNotNull() & (n > 1), F.lit("duplicate key"))]
    found = rows.withColumn("problem", F.array(*rules))
    return found.select("file", "line_no", F.explode(F.filter("problem", lambda x: x.isNotNull())).alias("problem"))
