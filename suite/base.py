"""Helpers shared by the driver queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def collector() -> tuple[dict, Callable[[str | None], Callable[[Query], Query]]]:
    """A dict and a decorator that files a query under its name together with its SQL."""
    suite: dict[str, tuple[Query, str | None]] = {}

    def query(sql: str | None = None) -> Callable[[Query], Query]:
        def register(fn: Query) -> Query:
            suite[fn.__name__] = (fn, sql)
            return fn
        return register

    return suite, query


def day(col: Column, pattern: str) -> Column:
    return F.date_format(col, pattern)


def written_date() -> Column:
    """Order date as text in the forms a supplier might use, with blanks, junk and impossible days.

    The form follows the order priority and status, so every order takes part.
    """
    d, p, s = F.col("o_orderdate"), F.col("o_orderpriority"), F.col("o_orderstatus")
    return (
        F.when(p == "1-URGENT", F.date_format(d, "dd/MM/yyyy"))
        .when(p == "2-HIGH", F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(p == "3-MEDIUM", F.date_format(d, "yyyyMMdd"))
        .when((p == "4-NOT SPECIFIED") & (s == "F"), F.lit("  "))
        .when((p == "4-NOT SPECIFIED") & (s == "O"), F.concat(F.lit("on "), F.date_format(d, "yyyy")))
        .when(p == "4-NOT SPECIFIED", F.concat(F.lit("31/02/"), F.date_format(d, "yyyy")))
        .when((p == "5-LOW") & (s == "F"), F.lit(None))
        .when((p == "5-LOW") & (s == "O"), F.date_format(d, "yyyyMMddHHmmss"))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )


# The same text in SQL, and the date it stands for.
WRITTEN_DATE = """CASE
  WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%Y%m%d')
  WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN '  '
  WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN 'on ' || strftime(o_orderdate, '%Y')
  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '31/02/' || strftime(o_orderdate, '%Y')
  WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL
  WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y%m%d%H%M%S')
  ELSE strftime(o_orderdate, '%Y-%m-%d') END"""
PARSED_DATE = """CAST(coalesce(try_strptime(raw, '%d/%m/%Y %H:%M:%S'), try_strptime(raw, '%d/%m/%Y'),
  try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%Y%m%d'), try_strptime(raw, '%Y%m%d%H%M%S'),
  try_strptime(raw, '%Y-%m-%d')) AS DATE)"""
DATE_ERROR = f"""CASE WHEN raw IS NULL OR {PARSED_DATE} IS NOT NULL THEN NULL
  WHEN trim(raw) = '' THEN 'EMPTY_DATE' ELSE 'INVALID_DATE' END"""


def decimal_text(col: str) -> Column:
    """A number as exact two-digit text."""
    return F.col(col).cast("decimal(18,2)").cast("string")
