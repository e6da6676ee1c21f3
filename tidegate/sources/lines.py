"""Line numbers without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.operators.aggregates import dealt_by_range
from tidegate.session import tune
from tidegate.sources.delimited import BLOCK, FILE, ROW

LINE = "line_id"


def count_splits(df: DataFrame, *more: Column) -> DataFrame:
    """One row per file split: its first row position and number of lines, and any further aggregates."""
    return df.groupBy(FILE, BLOCK).agg(F.min(ROW).alias("_first"), F.count(F.lit(1)).alias("_lines"), *more)


def split_offsets(splits: DataFrame, per_file: bool = True) -> DataFrame:
    """The number of lines before each split, in its file or in all files.

    The windows run over splits, not lines: a thousand terabytes of input are a few million rows here. Through all files
    the splits are dealt to tasks by ranges, and only one row per task is summed in one place.
    """
    def before(*by: str, order: str) -> Column:
        window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_lines").over(window), F.lit(0))

    if per_file:
        return splits.select(FILE, BLOCK, "_first", before(FILE, order=BLOCK).alias("_before"))
    dealt = dealt_by_range(splits.select(FILE, BLOCK, "_first", "_lines"), [], [F.col(FILE), F.col(BLOCK)]).withColumn("_part", F.shiftright("_at", 33))
    parts = dealt.groupBy("_part").agg(F.sum("_lines").alias("_lines")).select("_part", before(order="_part").alias("_earlier"))
    within = dealt.select(FILE, BLOCK, "_first", "_part", before("_part", order="_at").alias("_within"))
    return within.join(parts, "_part").select(FILE, BLOCK, "_first", (F.col("_within") + F.col("_earlier")).alias("_before"))


def with_line_id(df: DataFrame, per_file: bool = True, offsets: DataFrame | None = None) -> DataFrame:
    """Number lines 1..n in file order from the lineage columns of a scan.

    Counting splits is a narrow first pass; the second pass adds an offset to the position inside the
    split, so no line is shuffled. ``per_file=False`` continues the count through the files in name order.
    A frame that is read several times passes its stored ``offsets``.
    """
    tune(df.sparkSession)
    offsets = split_offsets(count_splits(df), per_file) if offsets is None else offsets
    kept = [F.col(f"`{c}`") for c in df.columns if c != LINE]
    line = (F.col(ROW) - F.col("_first") + F.col("_before") + 1).alias(LINE)
    return df.join(offsets, [FILE, BLOCK]).select(*kept, line)
