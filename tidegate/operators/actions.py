"""What happens to rows with a null in a required column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.settings import tolerance_column
from tidegate.operators.shape import column
from tidegate.rules import ColumnRule
from tidegate.session import sized, staged

# Fixed value: share of flagged columns a row may miss.
ROW_SHARE = 0.1


def required(rules: Sequence[ColumnRule]) -> list[ColumnRule]:
    return [r for r in rules if not r.is_nullable]


def is_null(rule: ColumnRule) -> Column:
    return column(rule.column_name).isNull()


def rejected(rules: Sequence[ColumnRule]) -> Column:
    """A null in some REJECT column."""
    out = F.lit(False)
    for rule in required(rules):
        if rule.error_action == "REJECT":
            out = out | is_null(rule)
    return out


def action_counts(rules: Sequence[ColumnRule]) -> list[Column]:
    """Null counts per required column for an aggregation.

    Rules act in order: rows rejected by an earlier column are not counted for a later one.
    """
    out, gone = [], F.lit(False)
    for i, rule in enumerate(required(rules)):
        out.append(F.count_if(~gone & is_null(rule)).alias(f"_null{i}"))
        if rule.error_action == "REJECT":
            gone = gone | is_null(rule)
    return out


def flagged_columns(rules: Sequence[ColumnRule]) -> Column:
    """Number of ICT_DRIVEN columns that have at least one null, out of the counts."""
    out = F.lit(0)
    for i, rule in enumerate(required(rules)):
        if rule.error_action == "ICT_DRIVEN":
            out = out + (F.col(f"_null{i}") > 0).cast("int")
    return out


def row_limit(flagged: Column, min_allowed: int = 1) -> Column:
    """Nulls a row may have in flagged columns."""
    return F.greatest(F.lit(min_allowed), F.floor(flagged * ROW_SHARE).cast("int"))


def invalid_columns(rules: Sequence[ColumnRule]) -> Column:
    """Nulls of a row in ICT_DRIVEN columns; columns without any null in the file add nothing."""
    out = F.lit(0)
    for rule in required(rules):
        if rule.error_action == "ICT_DRIVEN":
            out = out + is_null(rule).cast("int")
    return out


def aborted(rules: Sequence[ColumnRule], total: Column) -> Column:
    """First ICT_DRIVEN column whose share of nulls exceeds its own tolerance; NULL when none does."""
    tests = [
        F.when((total > 0) & (F.col(f"_null{i}") > tolerance_column(F.lit(rule.tolerance), total) * total),
               F.lit(rule.column_name))
        for i, rule in enumerate(required(rules))
        if rule.error_action == "ICT_DRIVEN" and rule.tolerance
    ]
    return F.coalesce(*tests, F.lit(None).cast("string"))


def action_summary(counts: DataFrame, rules: Sequence[ColumnRule], total: str, keep: Sequence[str] = ()) -> DataFrame:
    """Logged counts: REJECT and LOG_ONLY where rows are hit, ICT_DRIVEN_ABORT where a file is dropped."""
    stop = aborted(rules, F.col(total))
    entries = []
    for i, rule in enumerate(required(rules)):
        hits = F.col(f"_null{i}")
        kind = "ICT_DRIVEN_ABORT" if rule.error_action == "ICT_DRIVEN" else rule.error_action
        logged = stop == F.lit(rule.column_name) if rule.error_action == "ICT_DRIVEN" else hits > 0
        entries.append(F.when(logged, F.struct(F.lit(rule.column_name).alias("column_name"),
                                               F.lit(kind).alias("error_type"),
                                               hits.cast("long").alias("error_count"))))
    kind = "array<struct<column_name:string,error_type:string,error_count:bigint>>"
    return counts.select(*keep, F.inline(F.array_compact(F.array(*entries)).cast(kind)))


def apply_actions(df: DataFrame, rules: Sequence[ColumnRule], by: str | None = None,
                  min_allowed: int = 1) -> DataFrame:
    """Rows that survive the actions of all rules; the limits of a file come from one aggregation."""
    groups = df.groupBy(by) if by else df.groupBy()
    counts = groups.agg(F.count(F.lit(1)).alias("_rows"), *action_counts(rules))
    limit, stop = row_limit(flagged_columns(rules), min_allowed), aborted(rules, F.col("_rows"))
    if by:
        # One row per file: stored and measured, so that the lines stay where they are unless it is large.
        limits = sized(staged(counts.select(by, limit.alias("_limit"), stop.alias("_abort")), "limits"))
        rows = df.join(limits, by)
        allowed, going = F.col("_limit"), F.col("_abort").isNull()
    else:
        rows, allowed = df, counts.select(limit).scalar()
        going = counts.select(stop.isNull()).scalar()
    kept = rows.filter(going & ~rejected(rules) & (invalid_columns(rules) <= allowed))
    return kept.select([column(c) for c in df.columns])
