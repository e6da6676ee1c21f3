"""Checks that flag a value without changing it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
ADDRESS = r"^[0-9A-Za-zÀ-ÖØ-öø-ÿ][0-9A-Za-zÀ-ÖØ-öø-ÿ #,.'/-]*$"

# Check name -> error type.
CHECK_ERRORS = {"email": "INVALID_EMAIL", "address": "INVALID_ADDRESS", "enumeration": "INVALID_ENUM"}


def is_email(col: Column) -> Column:
    return F.trim(col).rlike(EMAIL)


def is_address(col: Column) -> Column:
    return F.trim(col).rlike(ADDRESS)


def in_list(col: Column, allowed: Sequence[str]) -> Column:
    return F.trim(col).isin(list(allowed))


def check(col: Column, kind: str | None, allowed: Sequence[str] = ()) -> Column | None:
    """Boolean expression for a named check, or None when the name is not a check."""
    if kind == "email":
        return is_email(col)
    if kind == "address":
        return is_address(col)
    return in_list(col, allowed) if allowed else None
