"""Bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.modes import PROCESS_DATE
from tidegate.operators.quality import expectations
from tidegate.sinks.tables import FILE_NAME, PARTITIONS

# Expectations on the silver table.
EXPECTED = {"valid_date": f"{PROCESS_DATE} IS NOT NULL", "valid_filename": f"{FILE_NAME} IS NOT NULL"}


def bronze(history: DataFrame) -> DataFrame:
    """The history table as received."""
    return history


def silver(source: DataFrame) -> DataFrame:
    """Distinct rows with a processing date. The filter comes first so that it reaches the scan."""
    return source.filter(F.col(PROCESS_DATE).isNotNull()).dropDuplicates()


def silver_violations(source: DataFrame) -> DataFrame:
    return expectations(silver(source), EXPECTED)


def gold(cleaned: DataFrame) -> DataFrame:
    """Records and processing times per day and file, latest day first."""
    daily = cleaned.groupBy(*PARTITIONS, FILE_NAME).agg(
        F.count(F.lit(1)).alias("total_records"), F.min(PROCESS_DATE).alias("first_processed"),
        F.max(PROCESS_DATE).alias("last_processed"))
    return daily.orderBy(*[F.desc(p) for p in PARTITIONS])
