"""Data-quality checks over whole files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.settings import tolerance_column
from tidegate.operators.cleanse import NULL_VALUE
from tidegate.operators.shape import column
from tidegate.session import staged

# Error codes of the whole-file checks, and the name that stands for all columns.
ALL_NULL = "FILE_EMPTY_OR_ALL_NULL"
NULL_KEY = "NULL_KEY"
COLUMN_ALL_NULL = "COLUMN ALL NULL"
DUPLICATE_KEY = "DUPLICATE_KEY"
ALL_COLUMNS = "ALL_COLUMNS"
ERROR_COLUMNS = ("table_name", "filename", "line_id", "column_name", "error_message", "error_count")


def _row(table: str, filename: Column, name: Column, message: str, count: Column) -> list[Column]:
    return [F.lit(table).alias("table_name"), filename.alias("filename"), F.lit(None).cast("long").alias("line_id"),
            name.alias("column_name"), F.lit(message).alias("error_message"),
            count.cast("long").alias("error_count")]


def column_profile(df: DataFrame, data_columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Rows and non-null counts per column, for the frame or per file, in one aggregation."""
    counts = [F.count(F.lit(1)).alias("_rows")]
    counts += [F.count(column(c)).alias(f"_n{i}") for i, c in enumerate(data_columns)]
    return (df.groupBy(by) if by else df.groupBy()).agg(*counts)


def check_profile(profile: DataFrame, data_columns: Sequence[str], keys: Sequence[str], required: Sequence[str],
                  table: str, filename: Column) -> DataFrame:
    """Empty-file, null-key and all-null-column errors out of a profile.

    A file without any value gives a single row and no further ones.
    """
    seen = {c: F.col(f"_n{i}") for i, c in enumerate(data_columns)}
    empty = F.greatest(*seen.values(), F.lit(0).cast("long")) == 0
    entries = [F.when(empty, _struct(F.lit(ALL_COLUMNS), ALL_NULL, F.lit(1)))]
    for key in keys:
        nulls = F.col("_rows") - seen[key]
        entries.append(F.when(~empty & (nulls > 0), _struct(F.lit(key), NULL_KEY, nulls)))
    for name in required:
        entries.append(F.when(~empty & (seen[name] == 0), _struct(F.lit(name), COLUMN_ALL_NULL, F.col("_rows"))))
    flat = profile.select(filename.alias("filename"), F.explode(F.array_compact(F.array(*entries))).alias("_e"))
    return flat.select(F.lit(table).alias("table_name"), "filename", F.lit(None).cast("long").alias("line_id"), "_e.*")


def _struct(name: Column, message: str, count: Column) -> Column:
    return F.struct(name.alias("column_name"), F.lit(message).alias("error_message"),
                    count.cast("long").alias("error_count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], table: str, filename: Column | None = None,
                   by: str | None = None) -> DataFrame:
    """One DUPLICATE_KEY row per repeated key; counts are combined before the shuffle, so a hot key is one row."""
    groups = ([by] if by else []) + list(keys)
    counted = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    name = filename if filename is not None else F.lit(None).cast("string")
    return counted.select(*_row(table, name, F.lit(",".join(keys)), DUPLICATE_KEY, F.col("_c")))


def null_lines(df: DataFrame, required: Sequence[str], table: str, keep: Sequence[str] = ()) -> DataFrame:
    """One NULL_VALUE row per null in a required column, for all columns in a single pass."""
    names = F.array_compact(F.array(*[F.when(column(c).isNull(), F.lit(c)) for c in required]))
    some = F.lit(False)
    for c in required:
        some = some | column(c).isNull()
    flat = df.filter(some).select(*keep, "line_id", F.explode(names).alias("column_name"))
    return flat.select(F.lit(table).alias("table_name"), *keep, "line_id", "column_name",
                       F.lit(NULL_VALUE).alias("error_message"), F.lit(1).cast("long").alias("error_count"))


def check_data_quality(df: DataFrame, table: str, keys: Sequence[str], filename: str | None = None,
                       required: Sequence[str] = ()) -> DataFrame:
    """All whole-file checks of one file in the canonical error columns."""
    data = [c for c in df.columns if c != "line_id" and not c.startswith("_")]
    name = F.lit(filename).cast("string")
    # One row, read by three checks.
    profile = staged(column_profile(df, data), "profile")
    checks = check_profile(profile, data, keys, required, table, name)
    counts = {c: F.col(f"_n{i}") for i, c in enumerate(data)}
    # The profile is one row: an all-null file silences the other checks.
    has_values = profile.select(F.greatest(F.lit(0).cast("long"), *counts.values()) > 0).scalar()
    found = [checks]
    if keys:
        found.append(duplicate_keys(df, keys, table, name).filter(has_values))
    if required and "line_id" in df.columns:
        hollow = F.array_compact(F.array(*[F.when(counts[c] == 0, F.lit(c)) for c in required]))
        lines = null_lines(df, required, table).withColumn("filename", name)
        found.append(lines.filter(has_values & ~F.array_contains(profile.select(hollow).scalar(), F.col("column_name"))))
    return reduce(lambda a, b: a.unionByName(b), [f.select(*ERROR_COLUMNS) for f in found])


def corrupt_verdict(df: DataFrame, corrupt: str, tolerance: str, by: str | None = None) -> DataFrame:
    """Total and corrupt rows with the tolerated number and whether the file is accepted."""
    groups = df.groupBy(by) if by else df.groupBy()
    counted = groups.agg(F.count(F.lit(1)).alias("total_rows"),
                         F.count_if(F.col(corrupt).isNotNull()).alias("corrupt_rows"))
    allowed = tolerance_column(F.lit(tolerance), F.col("total_rows")) * F.col("total_rows")
    return counted.withColumns({"allowed_rows": allowed, "is_valid": F.col("corrupt_rows") <= allowed})


def error_summary(errors: DataFrame, top: int = 50) -> DataFrame:
    """Totals by message, largest first, with nulls told apart from format errors."""
    family = F.when(F.lower("error_message").contains("null"), F.lit("null")).otherwise(F.lit("format"))
    totals = errors.groupBy("error_message").agg(F.sum("error_count").cast("long").alias("total_count"))
    return totals.withColumn("family", family).orderBy(F.desc("total_count"), "error_message").limit(top)


def cleaned_rows(total_rows: int | Column, errors: DataFrame) -> DataFrame:
    """Rows left after the errors whose message says Invalid."""
    invalid = F.sum(F.when(F.col("error_message").contains("Invalid"), F.col("error_count")))
    total = F.lit(total_rows) if isinstance(total_rows, int) else total_rows
    return errors.agg(F.coalesce(invalid, F.lit(0)).cast("long").alias("invalid_rows")).select(
        total.cast("long").alias("total_rows"), "invalid_rows",
        (total - F.col("invalid_rows")).cast("long").alias("cleaned_rows"))


def expectations(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Violations per named predicate; a predicate that is NULL counts as violated, rows are kept."""
    counts = [F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias(f"_e{i}")
              for i, rule in enumerate(expected.values())]
    rows = [F.struct(F.lit(name).alias("expectation"), F.col("total_rows"), F.col(f"_e{i}").alias("violations"))
            for i, name in enumerate(expected)]
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *counts).select(F.inline(F.array(*rows)))
