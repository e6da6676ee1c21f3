"""Dates in several written forms."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.settings import as_text

# The date forms tried after a configured one, in this order.
BUILTIN_PATTERNS = (
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyyMMdd",
    "yyyyMMddHHmmss",
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss",
)


def patterns_for(configured: str | None) -> list[str]:
    first = as_text(configured)
    return list(dict.fromkeys(([first] if first else []) + list(BUILTIN_PATTERNS)))


# The numbers a two-digit field can hold, and the months of thirty days.
FIELD_RANGE = {"MM": ("01", "12"), "dd": ("01", "31"), "HH": ("00", "23"), "mm": ("00", "59"), "ss": ("00", "59")}
SHORT_MONTHS = ("04", "06", "09", "11")
PIECE = re.compile(r"'([^']+)'|([A-Za-z]+)|([^A-Za-z'])")


def shape_of(col: Column) -> Column:
    """The value with every digit written as 9."""
    return F.translate(col, "012345678", "999999999")


def pattern_shape(pattern: str) -> str | None:
    """The shape of text a fixed-width numeric pattern accepts; None when the width can vary."""
    if "''" in pattern:
        return None
    shape = ""
    for literal, letters, other in PIECE.findall(pattern):
        if letters and not re.fullmatch("(yyyy|MM|dd|HH|mm|ss)+", letters):
            return None
        shape += "9" * len(letters) if letters else re.sub("[0-9]", "9", literal or other)
    return shape


def fields_in_range(col: Column, pattern: str) -> Column:
    """For text of the pattern's shape: every field holds a possible number and the day fits its month."""
    out, part, at = F.lit(True), {}, 1
    for literal, letters, other in PIECE.findall(pattern):
        for field in re.findall("yyyy|MM|dd|HH|mm|ss", letters):
            part[field] = F.substring(col, at, len(field))
            at += len(field)
            if field in FIELD_RANGE:
                out = out & part[field].between(*FIELD_RANGE[field])
        at += len(literal or other)
    if "MM" in part and "dd" in part:
        out = out & ~((part["MM"] == "02") & (part["dd"] > "29"))
        out = out & ~((part["dd"] == "31") & part["MM"].isin(*SHORT_MONTHS))
    return out


def parse_timestamp(col: Column, patterns: Sequence[str], shape: Column | None = None) -> Column:
    """First pattern that fits, as a timestamp.

    Each pattern is tried only on text of its shape with fields in range: a failed attempt costs an
    exception inside the JVM, several hundred times the price of these tests. Pass ``shape`` when it is
    already a column of the frame.
    """
    shape = shape_of(col) if shape is None else shape
    tries = []
    for pattern in patterns:
        attempt = F.try_to_timestamp(col, F.lit(pattern))
        expected = pattern_shape(pattern)
        if expected is not None:
            attempt = F.when((shape == F.lit(expected)) & fields_in_range(col, pattern), attempt)
        tries.append(attempt)
    return F.coalesce(*tries)


def temporal_default(text: str | None, data_type: T.DataType) -> Column:
    """The configured default as a date or timestamp; NULL when blank or not a date."""
    given = as_text(text)
    if given is None:
        return F.lit(None).cast(data_type)
    return parse_timestamp(F.lit(given), patterns_for(None)).cast(data_type)


def parse_temporal(col: Column, data_type: T.DataType, configured: str | None = None,
                   shape: Column | None = None) -> Column:
    return parse_timestamp(col, patterns_for(configured), shape).cast(data_type)


def date_error(raw: Column, parsed: Column) -> Column:
    """EMPTY_DATE for blank text, INVALID_DATE for other text without a date, NULL otherwise."""
    return F.when(parsed.isNull() & raw.isNotNull(),
                  F.when(F.trim(raw) == "", F.lit("EMPTY_DATE")).otherwise(F.lit("INVALID_DATE")))
