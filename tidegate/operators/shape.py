"""Column sets: order, duplicates, missing columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column(name: str):
    """Reference to a column whose name may contain dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def trim_all(df: DataFrame) -> DataFrame:
    """Trim every text column."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select([F.trim(column(c)).alias(c) if c in text else column(c) for c in df.columns])


def dedup_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns whose names differ only by case."""
    first: dict[str, int] = {}
    for position, name in enumerate(df.columns):
        first.setdefault(name.lower(), position)
    unique = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return unique.select([F.col(f"_{i}").alias(df.columns[i]) for i in first.values()])


def move_first(df: DataFrame, leading: Sequence[str]) -> DataFrame:
    present = [c for c in leading if c in df.columns]
    return df.select([column(c) for c in present + [c for c in df.columns if c not in present]])


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in expected if c.lower() not in have]


def missing_column_errors(df: DataFrame, expected: Sequence[str], table: str, filename: str | None) -> DataFrame:
    """One MISSING_COLUMN row per expected column the frame lacks."""
    rows = [(table, filename, c, "MISSING_COLUMN") for c in missing_columns(df, expected)]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, filename string, column_name string, error_type string")


def fill_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected columns as text, absent ones as NULL, other columns untouched and in their place."""
    wanted = {c.lower() for c in expected}
    kept = [column(c).cast("string").alias(c) if c.lower() in wanted else column(c) for c in df.columns]
    return df.select(*kept, *[F.lit(None).cast("string").alias(c) for c in missing_columns(df, expected)])


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def harmonised(df: DataFrame) -> DataFrame:
    """Old error-log headings to the canonical ones."""
    # Old heading -> canonical heading.
    old = {"table": "table_name", "error": "error_message", "count": "error_count", "ts": "log_ts"}
    taken = {c.lower() for c in df.columns}
    return df.withColumnsRenamed(
        {c: old[c.lower()] for c in df.columns if c.lower() in old and old[c.lower()] not in taken})
