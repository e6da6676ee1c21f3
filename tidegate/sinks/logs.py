"""Execution and quality logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.shape import dedup_columns, harmonised
from tidegate.sinks.tables import write_partitioned

# Columns of the two logs.
EXECUTION_LOG = (
    "table_name string, filename string, input_format string, ingestion_mode string, output_zone string, "
    "row_count long, column_count long, masking_applied boolean, error_count long, error_message string, "
    "status string, duration double, env string, log_ts timestamp, yyyy int, mm int, dd int"
)
QUALITY_LOG = (
    "table_name string, filename string, line_id long, column_name string, error_type string, "
    "error_message string, raw_value string, error_count long, default_applied string, uri string, "
    "zone string, env string, log_ts timestamp, yyyy int, mm int, dd int"
)
SECRET_ZONE = "secret"


def to_schema(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the columns of a schema: cast when present, NULL when not, in order."""
    have = {c.lower(): c for c in df.columns}
    fields = T.StructType.fromDDL(ddl).fields
    return df.select([
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fields])


def dated(df: DataFrame, at: datetime) -> DataFrame:
    return df.withColumns({"log_ts": F.lit(at).cast("timestamp"), "yyyy": F.lit(at.year), "mm": F.lit(at.month),
                           "dd": F.lit(at.day)})


def quality_rows(errors: DataFrame, table: str, zone: str = "internal", env: str = "dev",
                 at: datetime | None = None) -> DataFrame:
    """Error rows of any layout in the columns of the quality log."""
    rows = harmonised(dedup_columns(errors))
    name = F.coalesce(F.col("table_name"), F.lit(table)) if "table_name" in rows.columns else F.lit(table)
    kind = [F.col(c) for c in ("error_message", "error_type") if c in rows.columns]
    rows = rows.withColumns({"table_name": name, "zone": F.lit(zone), "env": F.lit(env)})
    rows = rows.withColumn("error_message", F.coalesce(*kind)) if kind else rows
    count = F.coalesce(F.col("error_count"), F.lit(1)) if "error_count" in rows.columns else F.lit(1)
    return to_schema(dated(rows.withColumn("error_count", count), at or datetime.now()), QUALITY_LOG)


def execution_rows(runs: DataFrame, env: str = "dev", at: datetime | None = None) -> DataFrame:
    """Run rows of any subset of columns in the columns of the execution log."""
    named = runs.withColumn("env", F.lit(env))
    if "masking_applied" not in runs.columns and "output_zone" in runs.columns:
        named = named.withColumn("masking_applied", F.col("output_zone") == SECRET_ZONE)
    return to_schema(dated(named, at or datetime.now()), EXECUTION_LOG)


def run_row(spark: SparkSession, **values) -> DataFrame:
    """One execution as a frame; names as in the log."""
    fields = [f for f in T.StructType.fromDDL(EXECUTION_LOG).fields if f.name in values]
    return spark.createDataFrame([tuple(values[f.name] for f in fields)], T.StructType(fields))


def append_log(rows: DataFrame, path: str, files: int | None = None, fmt: str = "parquet") -> None:
    """Append to a dated log; ``files`` bounds the number of files for rows known to be few."""
    write_partitioned(rows if files is None else rows.coalesce(files), path, "append", fmt)
