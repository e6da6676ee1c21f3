"""Membership in enumerations too large for an expression: a join that flags rows and keeps every one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.shape import column
from tidegate.session import BROADCAST_LIMIT, broadcast_if_small, measured_bytes, staged


def value_list(spark: SparkSession, path: str) -> DataFrame:
    """The distinct values of a stored list: the first column of a CSV file with a heading, or of a Parquet table."""
    reader = spark.read
    rows = reader.option("header", True).csv(path) if path.rstrip("/").lower().endswith(".csv") else reader.parquet(path)
    value = F.trim(column(rows.columns[0]).cast("string"))
    return rows.select(value.alias("value")).filter("value IS NOT NULL").distinct()


def flag_members(df: DataFrame, name: str, values: DataFrame, flag: str, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Add a boolean column: is the (trimmed) text of a column in a list? NULL where the column is.

    The list is stored and measured. A small one is broadcast, so no row moves. Otherwise both sides are shuffled by value: a
    value that many rows share is one row of the list, so Spark can split its rows; null rows match nothing and are
    spread by a key of their own.
    """
    listed = staged(values.select(F.col("value").alias("_value"), F.lit(True).alias("_listed")), "values")
    listed = broadcast_if_small(listed, measured_bytes(listed), limit)
    # No value in the list begins with this mark.
    apart = F.concat(F.lit("\u0000"), F.xxhash64(*[column(c) for c in df.columns]).cast("string"))
    keyed = df.withColumn("_key", F.coalesce(F.trim(column(name)), apart))
    joined = keyed.join(listed, F.col("_key") == F.col("_value"), "left")
    hit = F.when(column(name).isNotNull(), F.col("_listed").isNotNull())
    return joined.select(*[column(c) for c in df.columns], hit.alias(flag))
