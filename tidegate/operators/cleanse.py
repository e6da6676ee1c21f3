"""Rules compiled into projections: text -> typed value, plus the errors found on the way."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.checks import CHECK_ERRORS, check
from tidegate.functions.dates import date_error, parse_temporal, shape_of, temporal_default
from tidegate.functions.text import TRANSFORMS, transform
from tidegate.functions.typing import is_temporal, safe_cast, spark_type
from tidegate.operators.members import flag_members, value_list
from tidegate.operators.shape import column
from tidegate.rules import ColumnRule
from tidegate.session import tune

ERRORS = "_errors"
ERROR_STRUCT = "struct<column_name:string,error_type:string,raw_value:string,default_applied:string>"

# Error types logged per line.
TYPE_MISMATCH, NULL_VALUE, ICT_DRIVEN = "TYPE_MISMATCH", "NULL_VALUE", "ICT_DRIVEN"


def rule_type(rule: ColumnRule) -> T.DataType:
    return spark_type(rule.field_type, rule.decimal_precision, rule.decimal_scale)


def cleanse(df: DataFrame, rules: Sequence[ColumnRule], trim: bool = False) -> DataFrame:
    """Type and check every ruled column of a text frame; other columns pass through (trimmed, if asked for).

    Three projections: transformed text, valid value, value with default and errors. They stay separate
    in the plan wherever merging them would evaluate a parse twice, and run in one stage. Stage the result
    when it feeds several passes, or when rows are filtered by it: Catalyst would push the filter below and
    parse a second time.
    """
    tune(df.sparkSession)
    present = {c.lower() for c in df.columns}
    active = [r for r in rules if r.column_name.lower() in present]
    names = {r.column_name.lower(): i for i, r in enumerate(active)}
    raw = {i: column(r.column_name) for i, r in enumerate(active)}

    texts: list[Column] = []
    for i, rule in enumerate(active):
        text = F.trim(raw[i]) if trim else raw[i]
        text = transform(text, rule.transformation_type, rule.transformation_pattern, rule.regex_replacement)
        texts.append(text.alias(f"_t{i}"))
    step = df.select("*", *texts)
    temporal = [i for i, r in enumerate(active) if is_temporal(rule_type(r))]
    if temporal:
        step = step.select("*", *[shape_of(F.col(f"_t{i}")).alias(f"_s{i}") for i in temporal])

    for i, rule in enumerate(active):
        if rule.enumeration_table:
            step = flag_members(step, f"_t{i}", value_list(df.sparkSession, rule.enumeration_table), f"_m{i}")

    step = step.select("*", *[_valid(i, rule).alias(f"_v{i}") for i, rule in enumerate(active)])

    outputs, found = [], []
    for field in df.schema.fields:
        i = names.get(field.name.lower())
        if i is not None:
            outputs.append(_value(i, active[i]).alias(field.name))
        elif trim and isinstance(field.dataType, T.StringType) and not field.name.startswith("_"):
            outputs.append(F.trim(column(field.name)).alias(field.name))
        else:
            outputs.append(column(field.name))
    for i, rule in enumerate(active):
        found += _errors(i, rule, raw[i])
    return step.select(*outputs, _collected(found).alias(ERRORS))


def _collected(found: list[tuple[Column, Column]]) -> Column:
    """Errors of a row as an array, NULL for a clean row, which then costs a few comparisons only."""
    listed = F.lit(None)
    if found:
        some = reduce(lambda a, b: a | b, [kind.isNotNull() for kind, _ in found])
        parts = [F.when(kind.isNotNull(), F.array(item)).otherwise(no_errors()) for kind, item in found]
        listed = F.when(some, F.concat(*parts))
    return listed.cast(f"array<{ERROR_STRUCT}>")


def _valid(i: int, rule: ColumnRule) -> Column:
    """The typed value, NULL when the text is not one or fails its check."""
    text, kind = F.col(f"_t{i}"), rule_type(rule)
    if is_temporal(kind):
        pattern = rule.transformation_pattern
        if rule.transformation_type in TRANSFORMS or rule.transformation_type in CHECK_ERRORS:
            pattern = None
        return parse_temporal(text, kind, pattern, F.col(f"_s{i}"))
    passed = _passed(i, rule)
    value = safe_cast(text, kind)
    return value if passed is None else F.when(passed, value)


def _passed(i: int, rule: ColumnRule) -> Column | None:
    """Whether the text passes its check, if it has one."""
    passed = check(F.col(f"_t{i}"), rule.transformation_type, rule.enumeration)
    if not rule.enumeration_table:
        return passed
    return F.col(f"_m{i}") if passed is None else passed & F.col(f"_m{i}")


def _value(i: int, rule: ColumnRule) -> Column:
    kind, value = rule_type(rule), F.col(f"_v{i}")
    if rule.default_invalid is None:
        return value
    if is_temporal(kind):
        return F.coalesce(value, temporal_default(rule.default_invalid, kind))
    return F.coalesce(value, safe_cast(F.lit(rule.default_invalid), kind))


def _errors(i: int, rule: ColumnRule, raw: Column) -> list[tuple[Column, Column]]:
    text, value = F.col(f"_t{i}"), F.col(f"_v{i}")
    kind = rule_type(rule)
    out = []
    if is_temporal(kind):
        out.append(_entry(rule, date_error(text, value), raw))
    else:
        wrong = value.isNull() & text.isNotNull() & (F.trim(text) != "")
        if _passed(i, rule) is not None:
            failed = CHECK_ERRORS.get(rule.transformation_type or "", CHECK_ERRORS["enumeration"])
            out.append(_entry(rule, F.when(wrong, F.lit(failed)), raw))
        elif not isinstance(kind, T.StringType):
            out.append(_entry(rule, F.when(wrong, F.lit(TYPE_MISMATCH)), raw))
    if not rule.is_nullable and rule.error_action == ICT_DRIVEN:
        out.append(_entry(rule, F.when(_value(i, rule).isNull(), F.lit(ICT_DRIVEN)), raw))
    return out


def entry(name: Column, error_type: Column, raw: Column, default: Column | None = None) -> Column:
    """An error in the layout of the error column."""
    blank = F.lit(None).cast("string")
    return F.struct(name.cast("string").alias("column_name"), error_type.alias("error_type"),
                    raw.cast("string").alias("raw_value"),
                    (blank if default is None else default.cast("string")).alias("default_applied"))


def no_errors() -> Column:
    return F.array().cast(f"array<{ERROR_STRUCT}>")


def _entry(rule: ColumnRule, error_type: Column, raw: Column) -> tuple[Column, Column]:
    return error_type, entry(F.lit(rule.column_name), error_type, raw, F.lit(rule.default_invalid))


def error_lines(df: DataFrame, rules: Sequence[ColumnRule], table: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per error of a cleansed frame that has ``line_id``; a narrow, shuffle-free pass.

    The outer explode matters: for a plain one Catalyst infers a filter on the array and pushes it below
    the projections, where the whole cleansing would run a second time.
    """
    tokens = F.create_map(*[F.lit(x) for r in rules for x in (r.column_name, r.field_type)])
    flat = df.select(*keep, "line_id", F.explode_outer(ERRORS).alias("_e")).filter(F.col("_e").isNotNull())
    place = F.concat(F.lit("[line "), F.col("line_id"), F.lit(", value="),
                     F.coalesce(F.col("_e.raw_value"), F.lit("None")), F.lit("]"))
    kind = F.col("_e.error_type")
    message = (
        F.when(kind == TYPE_MISMATCH, F.concat(F.lit("TYPE MISMATCH : Expected type "),
                                               tokens[F.col("_e.column_name")], F.lit(", but found : "), place))
        .when(kind == ICT_DRIVEN, F.concat(F.lit(NULL_DETAIL), place))
        .otherwise(kind)
    )
    return flat.select(F.lit(table).alias("table_name"), *keep, "line_id", "_e.*", message.alias("error_message"),
                       F.lit(1).cast("long").alias("error_count"))


# Fixed value: opening of the log text for a null in a required column.
NULL_DETAIL = "Null value detected [not authorized], ICT count is incremented : "
