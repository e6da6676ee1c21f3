"""File names: patterns, dates and stems."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Placeholder -> number of digits, and the log texts for bad names.
PLACEHOLDERS = {"yyyy": 4, "mm": 2, "dd": 2, "hhmmss": 6}
MISSING_NAME_DATE = "Missing/invalid date pattern in filename"
INVALID_NAME_DATE = "INVALID DATE in filename"

PLACEHOLDER = re.compile(r"(_?)[<{](yyyy|mm|dd|hhmmss)[>}]", re.IGNORECASE)
NAME_DATE = r"(\d{4})(\d{2})(\d{2})?(?:_?(\d{2})(\d{2})(\d{2}))?"
SPACED_DATE = r"(\d{4})[_-](\d{2})[_-](\d{2})"


def _walk(pattern: str, literal, digits, optional) -> str:
    """Rebuild a name pattern piece by piece; the time of day is optional together with its underscore."""
    out, at = "", 0
    for hit in PLACEHOLDER.finditer(pattern):
        out += literal(pattern[at:hit.start()])
        token = hit.group(2).lower()
        piece = literal(hit.group(1)) + digits(PLACEHOLDERS[token])
        out += optional(piece) if token == "hhmmss" else piece
        at = hit.end()
    return out + literal(pattern[at:])


def name_regex(pattern: str) -> str:
    """Regular expression for a whole file name."""
    body = _walk(pattern, re.escape, lambda n: rf"\d{{{n}}}", lambda piece: f"(?:{piece})?")
    return f"^{body}$"


def name_glob(pattern: str) -> str:
    """The same as a glob, so that the file listing itself filters."""
    def quoted(text: str) -> str:
        return re.sub(r"([*?\[\]{}\\,])", r"\\\1", text)

    return _walk(pattern, quoted, lambda n: "[0-9]" * n, lambda piece: "{" + piece + ",}")


def has_date(pattern: str) -> bool:
    """Whether file names of this pattern carry a date."""
    return any(hit.group(2).lower() == "yyyy" for hit in PLACEHOLDER.finditer(pattern))


def decoded(uri: Column) -> Column:
    """File path as the listing shows it: a scan reports it percent-encoded, with plus signs as they are."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def name_parts(name: Column) -> Column:
    """struct(yyyy, mm, dd, hh, mi, ss) of the first date in a file name; absent parts are NULL."""
    base = base_name(name)
    base = F.when(base.rlike(NAME_DATE), base).otherwise(F.regexp_replace(base, SPACED_DATE, "$1$2$3"))

    # One search per name; the pieces have fixed places in what it finds.
    found = F.regexp_extract(base, NAME_DATE, 0)
    date = F.substring_index(found, "_", 1)
    time = F.when(found.contains("_"), F.substring_index(found, "_", -1)).otherwise(F.substring(date, 9, 6))
    places = {"yyyy": (date, 1, 4), "mm": (date, 5, 2), "dd": (date, 7, 2),
              "hh": (time, 1, 2), "mi": (time, 3, 2), "ss": (time, 5, 2)}
    pieces = {name: F.substring(text, start, size) for name, (text, start, size) in places.items()}
    return F.struct(*[F.when(piece != "", piece.cast("int")).alias(name) for name, piece in pieces.items()])


def name_date(name: Column) -> Column:
    """Calendar date of a file name; a missing day counts as the first, an impossible date is NULL."""
    parts = name_parts(name)
    day = F.coalesce(parts["dd"], F.lit(1))
    text = F.format_string("%04d-%02d-%02d", parts["yyyy"], parts["mm"], day)
    return F.when(parts["yyyy"].isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def name_error(name: Column) -> Column:
    parts = name_parts(name)
    return F.when(parts["yyyy"].isNull(), F.lit(MISSING_NAME_DATE)).when(
        name_date(name).isNull(), F.lit(INVALID_NAME_DATE)
    )
