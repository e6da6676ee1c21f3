"""Writers: partitioned tables, states, logs, catalog."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from suite.base import collector, table
from tidegate.functions.files import stem
from tidegate.operators.shape import dedup_columns
from tidegate.session import fresh_path
from tidegate.sinks.catalog import register_table
from tidegate.sinks.logs import append_log, execution_rows, quality_rows
from tidegate.sinks.tables import CurrentTable, balanced, read_table, stamp, without, write_partitioned

SUITE, query = collector()

AT = datetime(2025, 12, 1, 12, 0, 1)
ORDER = ["o_orderkey", "o_orderstatus", "o_totalprice"]


def monthly(df):
    """Orders stamped with the month of their date, as a monthly file would be."""
    return stamp(df, {"yyyy": F.year("o_orderdate"), "mm": F.month("o_orderdate")},
                 stem(F.concat(F.lit("/drop/orders_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".csv"))), AT)


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END
    AS o_orderpriority FROM orders""")
def append_evolve(spark, folder):
    """A second append brings a new column; earlier rows read it as NULL."""
    path = fresh_path(spark, "evolve")
    o = table(spark, folder, "orders")
    o.filter("o_orderstatus = 'F'").select(*ORDER).write.mode("append").parquet(path)
    o.filter("o_orderstatus <> 'F'").select(*ORDER, "o_orderpriority").write.mode("append").parquet(path)
    return read_table(spark, path)


@query("""SELECT 'orders_' || strftime(o_orderdate, '%Y%m') AS "FILE_NAME_RECEIVED",
    TIMESTAMP '2025-12-01 12:00:01' AS "FILE_PROCESS_DATE", o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yyyy,
    CAST(month(o_orderdate) AS INTEGER) AS mm, 1 AS dd FROM orders""")
def audit_columns(spark, folder):
    rows = monthly(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"))
    return without(rows, "o_orderdate").withColumn("FILE_PROCESS_DATE", F.col("FILE_PROCESS_DATE").cast("timestamp_ntz"))


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS yyyy, CAST(month(o_orderdate) AS INTEGER) AS mm, 1 AS dd,
    count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1, 2""")
def partitioned_write(spark, folder):
    path = fresh_path(spark, "parts")
    write_partitioned(balanced(monthly(table(spark, folder, "orders"))), path)
    stored = read_table(spark, path)
    return stored.groupBy("yyyy", "mm", "dd").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def dedup_column_names(spark, folder):
    c = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    return dedup_columns(c.toDF("c_custkey", "c_name", "c_nationkey", "C_NAME", "C_Nationkey"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def registered_table(spark, folder):
    path, name = fresh_path(spark, "table"), f"t_{uuid.uuid4().hex}"
    table(spark, folder, "orders").select(*ORDER).write.parquet(path)
    register_table(spark, name, path)
    register_table(spark, name, path, if_exists="append")
    register_table(spark, name, path, if_exists="overwrite")
    return spark.table(f"default.{name}")


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice * 2 FROM orders WHERE o_orderstatus <> 'F'""")
def current_table(spark, folder):
    """Replace, replace by a state computed from itself, then append."""
    o = table(spark, folder, "orders").select(*ORDER, "o_orderdate")
    current = CurrentTable(spark, fresh_path(spark, "orders_last"))
    current.replace(monthly(o))
    current.replace(current.read().filter("o_orderstatus <> 'F'"))
    again = current.read().withColumn("o_totalprice", F.col("o_totalprice") * 2)
    location = current.append(again)
    return read_table(spark, location).select(*ORDER)


@query("""SELECT 'orders' AS table_name, o_orderpriority || '.csv' AS filename, CAST(NULL AS VARCHAR) AS input_format,
    'MERGE' AS ingestion_mode, CASE WHEN o_orderpriority = '1-URGENT' THEN 'secret' ELSE 'internal' END AS output_zone,
    count(*) AS row_count, CAST(7 AS BIGINT) AS column_count, o_orderpriority = '1-URGENT' AS masking_applied,
    CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS error_count, CAST(NULL AS VARCHAR) AS error_message, 'SUCCESS' AS status,
    CAST(NULL AS DOUBLE) AS duration, 'dev' AS env, TIMESTAMP '2025-12-01 12:00:01' AS log_ts, 2025 AS yyyy, 12 AS mm, 1 AS dd
    FROM orders GROUP BY o_orderpriority""")
def execution_log(spark, folder):
    path = fresh_path(spark, "execution")
    p = F.col("o_orderpriority")
    runs = table(spark, folder, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("o_orderstatus") == "P").alias("error_count")).select(
        F.lit("orders").alias("table_name"), F.concat(p, F.lit(".csv")).alias("filename"),
        F.lit("MERGE").alias("ingestion_mode"), F.when(p == "1-URGENT", "secret").otherwise("internal").alias("output_zone"),
        "row_count", F.lit(7).alias("column_count"), "error_count", F.lit("SUCCESS").alias("status"))
    append_log(execution_rows(runs, "dev", AT), path, files=1)
    return read_table(spark, path).withColumn("log_ts", F.col("log_ts").cast("timestamp_ntz"))


@query("""SELECT CASE WHEN o_orderstatus = 'F' THEN 'orders' ELSE 'other' END AS table_name,
    CAST(NULL AS VARCHAR) AS filename, o_orderkey AS line_id, 'o_totalprice' AS column_name,
    CAST(NULL AS VARCHAR) AS error_type, 'too dear' AS error_message, CAST(o_custkey AS VARCHAR) AS raw_value,
    CAST(1 AS BIGINT) AS error_count, CAST(NULL AS VARCHAR) AS default_applied, CAST(NULL AS VARCHAR) AS uri,
    'internal' AS zone, 'dev' AS env, TIMESTAMP '2025-12-01 12:00:01' AS log_ts, 2025 AS yyyy, 12 AS mm, 1 AS dd
    FROM orders WHERE o_totalprice > 100000""")
def quality_log(spark, folder):
    path = fresh_path(spark, "quality")
    bad = table(spark, folder, "orders").filter("o_totalprice > 100000").select(
        F.when(F.col("o_orderstatus") != "F", "other").alias("Table"), F.lit("too dear").alias("Error"),
        F.col("o_orderkey").alias("line_id"), F.lit("o_totalprice").alias("column_name"),
        F.col("o_custkey").alias("raw_value"))
    append_log(quality_rows(bad, "orders", at=AT), path)
    return read_table(spark, path).withColumn("log_ts", F.col("log_ts").cast("timestamp_ntz"))
