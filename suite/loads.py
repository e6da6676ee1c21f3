"""Whole loads: files to state and summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from suite.base import PARSED_DATE, WRITTEN_DATE, collector, decimal_text, table, written_date
from tidegate.operators import actions
from tidegate.operators.cleanse import cleanse
from tidegate.operators.modes import merge_newest
from tidegate.plans.intake import Layout, load_table
from tidegate.rules import ColumnRule, TableRule
from tidegate.session import fresh_path, staged
from tidegate.sinks.tables import CurrentTable, read_table

SUITE, query = collector()

RULES = [
    ColumnRule("custkey", field_type="LONG", is_nullable=False, is_merge_key=True),
    ColumnRule("orderkey", field_type="LONG", is_nullable=False),
    ColumnRule("orderdate", field_type="DATE", default_invalid="1990-01-01", is_start_validity=True),
    ColumnRule("totalprice", field_type="DOUBLE", is_nullable=False, error_action="REJECT"),
    ColumnRule("priority", transformation_type="lowercase"),
]
RAW = f"""raw_orders AS (SELECT o_orderkey, CASE WHEN o_totalprice > 150000 OR o_orderpriority <> '5-LOW' THEN o_custkey END
    AS custkey, CASE WHEN o_totalprice <= 400000 THEN o_totalprice END AS totalprice, o_orderpriority,
    {WRITTEN_DATE} AS raw, o_orderstatus FROM orders),
    typed AS (SELECT custkey, o_orderkey AS orderkey, coalesce({PARSED_DATE}, DATE '1990-01-01') AS orderdate, totalprice,
    lower(o_orderpriority) AS priority, o_orderstatus FROM raw_orders WHERE totalprice IS NOT NULL)"""


def raw_orders(spark, folder):
    return as_delivered(table(spark, folder, "orders"))


def as_delivered(orders):
    """Orders as a supplier would write them: comma decimals, mixed dates, missing customers, absurd prices."""
    price, p = F.col("o_totalprice"), F.col("o_orderpriority")
    return orders.select(
        F.when((price > 150000) | (p != "5-LOW"), F.col("o_custkey").cast("string")).alias("custkey"),
        F.col("o_orderkey").cast("string").alias("orderkey"), written_date().alias("orderdate"),
        F.when(price > 400000, "n/a").otherwise(F.translate(decimal_text("o_totalprice"), ".", ",")).alias("totalprice"),
        p.alias("priority"), F.col("o_orderstatus").alias("status"))


NEWEST = "QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY orderdate DESC, orderkey DESC) = 1"


@query(f"""WITH {RAW}, t AS (SELECT * FROM typed WHERE o_orderstatus = 'F' AND custkey IS NOT NULL {NEWEST}),
    b AS (SELECT * FROM typed WHERE o_orderstatus <> 'F' AND custkey IS NOT NULL {NEWEST}),
    m AS (SELECT t.custkey IS NOT NULL AND NOT coalesce(b.orderdate > t.orderdate, FALSE) AS keep, t, b
    FROM t FULL JOIN b ON t.custkey = b.custkey),
    s AS (SELECT CASE WHEN keep THEN t.orderdate ELSE b.orderdate END AS orderdate,
    CASE WHEN keep THEN t.totalprice ELSE b.totalprice END AS totalprice FROM m
    UNION ALL SELECT orderdate, totalprice FROM typed WHERE custkey IS NULL)
    SELECT CAST(year(orderdate) AS INTEGER) AS yyyy, CAST(month(orderdate) AS INTEGER) AS mm, count(*) AS total_records,
    CAST(sum(CAST(totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total_price, min(orderdate) AS first_day,
    max(orderdate) AS last_day FROM s GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC""")
def governed_orders(spark, folder):
    """Raw text to typed rows, error actions, newest-wins merge into a prior state, monthly summary."""
    delivered = staged(raw_orders(spark, folder), "delivered")
    typed = staged(cleanse(delivered, RULES, trim=True), "typed")
    clean = actions.apply_actions(typed, RULES).drop("_errors").withColumn("_line", F.col("orderkey"))
    state = staged(merge_newest(None, clean.filter("status = 'F'"), ["custkey"], "orderdate", ["_line"]), "state")
    state = merge_newest(state, clean.filter("status <> 'F'"), ["custkey"], "orderdate", ["_line"])
    return state.groupBy(F.year("orderdate").alias("yyyy"), F.month("orderdate").alias("mm")).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(F.col("totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total_price"),
        F.min("orderdate").alias("first_day"), F.max("orderdate").alias("last_day")).orderBy(
        F.desc("yyyy"), F.desc("mm"))


PLAIN = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def loaded(spark, folder, mode="DELTA_FROM_NON_HISTORIZED"):
    """Two deliveries of orders as CSV, each through a full load."""
    layout = Layout(inbox="", root=fresh_path(spark, "lake"))
    rule = TableRule("orders", header="FIRST LINE", ingestion_mode=mode, delimiter=";", merge_files=True)
    orders = table(spark, folder, "orders")
    at = datetime(2025, 12, 1, 12, 0, 1)
    runs = []
    for part in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"):
        source = fresh_path(spark, "delivery")
        # Sorted before the text is made: the ranges come out of a pass of their own over what is sorted.
        ranged = orders.filter(part).repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
        as_delivered(ranged).drop("status").write.options(sep=";", header=True, **PLAIN).csv(source)
        runs.append(load_table(spark, rule, RULES, layout, at, source))
    return layout, rule, runs


@query(f"""WITH {RAW}, t AS (SELECT * FROM typed WHERE o_orderstatus = 'F' AND custkey IS NOT NULL {NEWEST}),
    b AS (SELECT * FROM typed WHERE o_orderstatus <> 'F' AND custkey IS NOT NULL {NEWEST}),
    m AS (SELECT CASE WHEN t.custkey IS NOT NULL AND NOT coalesce(b.orderdate > t.orderdate, FALSE) THEN t ELSE b END AS r
    FROM t FULL JOIN b ON t.custkey = b.custkey)
    SELECT r.custkey, r.orderkey, r.orderdate, r.totalprice, r.priority FROM m
    UNION ALL SELECT custkey, orderkey, orderdate, totalprice, priority FROM typed WHERE custkey IS NULL""")
def load_merge(spark, folder):
    """State after both loads. Files and lines follow the order keys, which so decide among rows of the same day."""
    layout, rule, _ = loaded(spark, folder)
    return CurrentTable(spark, layout.table(rule, "last")).read().select("custkey", "orderkey", "orderdate", "totalprice", "priority")


@query(f"""WITH {RAW} SELECT custkey, orderkey, orderdate, totalprice, priority FROM typed""")
def load_history(spark, folder):
    layout, rule, _ = loaded(spark, folder, "FULL_SNAPSHOT")
    return read_table(spark, layout.table(rule, "all")).select("custkey", "orderkey", "orderdate", "totalprice", "priority")


@query(f"""WITH {RAW} SELECT 'orderdate' AS column_name, CASE WHEN trim(raw) = '' THEN 'EMPTY_DATE' ELSE 'INVALID_DATE' END
    AS error_type, count(*) AS n FROM raw_orders WHERE raw IS NOT NULL AND {PARSED_DATE} IS NULL GROUP BY 1, 2
    UNION ALL SELECT 'totalprice', 'TYPE_MISMATCH', count(*) FROM raw_orders WHERE totalprice IS NULL
    UNION ALL SELECT 'custkey', 'ICT_DRIVEN', count(*) FROM raw_orders WHERE custkey IS NULL
    UNION ALL SELECT 'custkey', 'NULL_VALUE', count(*) FROM raw_orders WHERE custkey IS NULL AND totalprice IS NOT NULL""")
def load_errors(spark, folder):
    """Per-line errors both loads left in the quality log."""
    layout, _, _ = loaded(spark, folder, "FULL_KEY_REPLACE")
    log = read_table(spark, layout.quality_log)
    lines = log.filter("line_id IS NOT NULL AND error_type IS NOT NULL")
    return lines.groupBy("column_name", "error_type").agg(F.count(F.lit(1)).alias("n"))
