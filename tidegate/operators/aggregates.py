"""Numeric profiles and numbering within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.operators.shape import column
from tidegate.session import sized, staged


def numeric_profile(df: DataFrame, value: str, by: Sequence[str] = (), accuracy: int = 100) -> DataFrame:
    """Rows, non-null values, sum, mean, deviation, extremes, spread and approximate median."""
    v = column(value)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), F.count(v).alias("value_count"), F.sum(v).alias("total"),
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("deviation"), F.min(v).alias("lowest"),
        F.max(v).alias("highest"), (F.max(v) - F.min(v)).alias("spread"),
        F.percentile_approx(v, 0.5, accuracy).alias("median"))


def row_numbers(df: DataFrame, group: Sequence[str], order: Sequence[Column], bucket: Column | None = None,
                name: str = "row_number") -> DataFrame:
    """``row_number`` within groups of any size.

    ``bucket`` must not decrease along the order (a day for a timestamp, say). Rows are numbered within
    (group, bucket), and the counts of earlier buckets are added, so a group is spread over many tasks.
    Without a bucket the rows are dealt by ranges, see ``range_numbers``.
    """
    if bucket is None:
        return range_numbers(df, group, order, name)
    # Group columns may be null. Structs of them are not, and compare nulls as equal, so one key serves the window
    # and the join and the rows are shuffled once.
    whole = F.struct(F.lit(0).alias("_"), *[column(c).alias(f"g{i}") for i, c in enumerate(group)])
    cut = df.withColumn("_cell", F.struct(whole.alias("group"), bucket.alias("bucket")))
    sizes = cut.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("_cell.group").orderBy("_cell.bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_cell", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    local = cut.withColumn("_local", F.row_number().over(Window.partitionBy("_cell").orderBy(*order)))
    numbered = (F.col("_local") + F.col("_before")).cast("long").alias(name)
    return local.join(offsets, "_cell").select([column(c) for c in df.columns] + [numbered])


def range_numbers(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """``row_number`` within groups, however the rows are spread over them.

    Rows are dealt to tasks by ranges of (group, order) and sorted there. A number is the place in the task less that of the
    group's first row, plus what earlier tasks hold of the group; that takes one row per task and group, whose window sees no more
    rows than there are tasks. Rows that are equal in the order are told apart by their place in the stored input, so that no range is
    bound to be large; their own order is arbitrary, as with any ``row_number``.
    """
    placed = dealt_by_range(df, group, order)
    # The upper bits of the identifier are the number of the task.
    part = F.shiftright("_at", 33)
    ends = placed.groupBy("_group", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("_group", "_part", (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    numbered = placed.withColumn("_part", part).join(sized(staged(offsets, "offsets")), ["_group", "_part"])
    return numbered.select([column(c) for c in df.columns] + [(F.col("_at") + F.col("_shift")).cast("long").alias(name)])


def dealt_by_range(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows sorted by (group, order) over all tasks, stored with ``_group`` and ``_at``, which grows along the order."""
    whole = F.struct(F.lit(0).alias("_"), *[column(c).alias(f"g{i}") for i, c in enumerate(group)])
    stored = staged(df.select("*", whole.alias("_group")), "keyed").withColumn("_nth", F.monotonically_increasing_id())
    by = [F.col("_group"), *order, F.col("_nth")]
    dealt = stored.repartitionByRange(*by).sortWithinPartitions(*by)
    return staged(dealt.withColumn("_at", F.monotonically_increasing_id()), "placed")


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], k: int = 1000) -> DataFrame:
    """Per group a KLL sketch of a column, a few kilobytes that can be stored beside the rows and merged later.

    The rank of a quantile read from it is off by about 2 / k of the rows at most.
    """
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(column(value).cast("double"), k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: Sequence[str], ranks: Sequence[float]) -> DataFrame:
    """Quantiles over the groups of several sketches; no row of the data is read again."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("_sketch"))
    return merged.select(*by, F.kll_sketch_get_n_double("_sketch").alias("value_count"),
                         *[F.kll_sketch_get_quantile_double("_sketch", F.lit(float(r))).alias(f"q{round(100 * r):02d}") for r in ranks])
