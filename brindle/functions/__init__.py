"""Column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later expressions use many times. Catalyst would copy each expression to all places that use it, until the generated code is too long to compile; a generator of one row keeps them apart."""
    return df.select("*", F.explode(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))).alias("__bound")).select(*df.columns, *[F.col(f"__bound.{k}") for k in columns])
