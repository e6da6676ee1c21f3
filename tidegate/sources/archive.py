"""Files inside ZIP archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.sources.delimited import CORRUPT, FILE, text_schema

LINES_PER_BATCH = 20_000
ARCHIVE_LINES = "archive string, member string, line_no long, line string"


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of ZIP files, one row per archive."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip")
    return reader.load(path).select("path", "content")


def archive_lines(frame: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """Every line of every member, decompressed as a stream; archives are spread over the cluster."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as box:
                    for member in sorted(n for n in box.namelist() if not n.endswith("/")):
                        with box.open(member) as raw:
                            yield from chunks(path, member, io.TextIOWrapper(raw, encoding=encoding))

    def chunks(path: str, member: str, text: io.TextIOWrapper) -> Iterator[pd.DataFrame]:
        number, lines = 0, []
        for line in text:
            lines.append(line.rstrip("\r\n"))
            if len(lines) == LINES_PER_BATCH:
                yield as_frame(path, member, number, lines)
                number, lines = number + len(lines), []
        if lines:
            yield as_frame(path, member, number, lines)

    def as_frame(path: str, member: str, before: int, lines: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"archive": path, "member": member,
                             "line_no": range(before + 1, before + len(lines) + 1), "line": lines})

    return frame.select("path", "content").mapInPandas(unpack, ARCHIVE_LINES)


def parse_lines(lines: DataFrame, columns: list[str], sep: str = ",", header: bool = True) -> DataFrame:
    """Delimited archive lines as text columns with their member name and line number."""
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    schema = ", ".join(f"`{f.name}` string" for f in text_schema(columns, corrupt=True).fields)
    data = lines.filter("line_no > 1") if header else lines
    number = F.col("line_no") - 1 if header else F.col("line_no")
    return data.select(F.from_csv("line", schema, options).alias("_c"), F.col("member").alias(FILE),
                       number.alias("line_id")).select("_c.*", FILE, "line_id")
