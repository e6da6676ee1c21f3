"""Text transforms by name, each taking (column, pattern, replacement)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.settings import bool_column

Transform = Callable[[Column, str | None, str | None], Column]


def capitalize(col: Column) -> Column:
    """First character upper, the rest lower."""
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 2147483647)))


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def concat_text(*cols: Column, sep: str = " ") -> Column:
    """Join values with a separator; NULL when any part is NULL."""
    parts: list[Column] = []
    for col in cols:
        parts += [F.lit(sep), col] if parts else [col]
    return F.concat(*parts)


def arguments(pattern: str | None, count: int) -> list[str]:
    """Split the ``a,b`` pattern of a two-argument transform; the last part may itself be a comma."""
    parts = (pattern or "").split(",", count - 1)
    if len(parts) != count or not parts[0].strip():
        raise ValueError(f"transform needs {count} comma-separated arguments, got {pattern!r}")
    return parts


def _replace(col: Column, pattern: str | None, replacement: str | None) -> Column:
    return F.regexp_replace(col, F.lit(pattern), F.lit(replacement or "")) if pattern else col


def _slice(col: Column, pattern: str | None, _: str | None) -> Column:
    start, length = arguments(pattern, 2)
    return F.substring(col, int(start), int(length))


def _pad(side: Callable[..., Column]) -> Transform:
    def apply(col: Column, pattern: str | None, _: str | None) -> Column:
        width, fill = arguments(pattern, 2)
        return side(col, int(width), fill)
    return apply


TRANSFORMS: dict[str, Transform] = {
    "uppercase": lambda c, p, r: F.upper(c),
    "lowercase": lambda c, p, r: F.lower(c),
    "capitalize": lambda c, p, r: capitalize(c),
    "trim": lambda c, p, r: F.trim(c),
    "ltrim": lambda c, p, r: F.ltrim(c),
    "rtrim": lambda c, p, r: F.rtrim(c),
    "regex": _replace,
    "regex_replace": _replace,
    "regex_extract": lambda c, p, r: F.regexp_extract(c, p or "(.*)", 1),
    "substring": _slice,
    "left": lambda c, p, r: F.substring(c, 1, int(p)),
    "right": lambda c, p, r: F.right(c, F.lit(int(p))),
    "lpad": _pad(F.lpad),
    "rpad": _pad(F.rpad),
    "blank_to_null": lambda c, p, r: blank_to_null(c),
    "bool": lambda c, p, r: bool_column(c, None).cast("string"),
}


def transform(col: Column, kind: str | None, pattern: str | None = None, replacement: str | None = None) -> Column:
    """Apply a named transform; unknown names (checks, date patterns) leave the value as it is."""
    found = TRANSFORMS.get((kind or "").strip().lower())
    return col if found is None else found(col, pattern, replacement)
