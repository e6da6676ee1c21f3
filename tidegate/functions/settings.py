"""Interpretation of configuration cells, as Python scalars and as column expressions."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of booleans, of an empty cell, and of delimiters.
TRUE_WORDS = ("true", "1", "yes", "y", "oui")
FALSE_WORDS = ("false", "0", "no", "n", "non")
BLANK_WORDS = ("", "nan", "none", "null", "n/a")
DELIMITER_WORDS = {"\\t": "\t", "tab": "\t", "pipe": "|"}

TOLERANCE_TEXT = r"^\d+(\.\d+)?%?$"


def as_text(value: Any) -> str | None:
    """Cell text without surrounding space; every spelling of an empty cell becomes None."""
    text = "" if value is None else str(value).strip()
    return None if text.lower() in BLANK_WORDS else text


def as_bool(value: Any, default: bool = False) -> bool:
    word = "" if value is None else str(value).strip().lower()
    if word in TRUE_WORDS:
        return True
    return False if word in FALSE_WORDS else default


def delimiter(value: str | None) -> str:
    """The separator for the reader: a comma when blank, otherwise exactly one character."""
    if value is None or (value not in ("\t", " ") and not value.strip()):
        return ","
    text = value if len(value) == 1 else value.strip()
    text = DELIMITER_WORDS.get(text.lower(), text)
    if len(text) != 1:
        raise ValueError(f"delimiter {value!r} is not a single character")
    return text


def header_mode(value: str | None) -> str:
    """``names`` takes names from line 1, ``skip`` drops line 1, ``none`` treats all lines as data."""
    words = (as_text(value) or "").upper().replace("_", " ")
    if words == "FIRST LINE":
        return "names"
    return "skip" if words in ("HEADER USE", "FIRST LINE ONLY") else "none"


def header_flags(value: str | None) -> tuple[bool, bool]:
    """(header present, only to be dropped)."""
    mode = header_mode(value)
    return mode != "none", mode == "skip"


def tolerance(value: Any, total: int, default: float = 0.0) -> float:
    """Tolerated share of rows: ``10%`` is 0.1, a plain number is that many rows out of ``total``."""
    text = as_text(value)
    if text is None:
        return default
    text = text.replace(" ", "").replace(",", ".")
    if not re.match(TOLERANCE_TEXT, text):
        return 0.0
    if text.endswith("%"):
        return float(text[:-1]) / 100.0
    return float(text) / total if total > 0 else 0.0


def allowed_rows(value: Any, total: int, default: float = 0.0) -> float:
    return tolerance(value, total, default) * total


def bool_column(col: Column, default: bool | None = False) -> Column:
    word = F.lower(F.trim(col))
    return (
        F.when(word.isin(*TRUE_WORDS), F.lit(True))
        .when(word.isin(*FALSE_WORDS), F.lit(False))
        .otherwise(F.lit(default).cast("boolean"))
    )


def tolerance_column(raw: Column, total: Column, default: float = 0.0) -> Column:
    """Column form of :func:`tolerance`."""
    text = F.regexp_replace(F.regexp_replace(raw, " ", ""), ",", ".")
    number = F.regexp_extract(text, r"^(\d+(?:\.\d+)?)%?$", 1).try_cast("double")
    blank = raw.isNull() | F.lower(F.trim(raw)).isin(*BLANK_WORDS)
    share = F.when(text.endswith("%"), number / 100.0).otherwise(F.try_divide(number, total))
    return F.when(blank, F.lit(default)).otherwise(F.coalesce(share, F.lit(0.0)))
