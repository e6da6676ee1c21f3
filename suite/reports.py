"""Aggregates, layered tables and dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import collector, table
from tidegate.operators.aggregates import numeric_profile, row_numbers
from tidegate.plans import medallion, reports

SUITE, query = collector()


@query("""SELECT event_type, count(*) AS row_count, count(nullif(value, 6.55)) AS value_count,
    round(avg(value), 6) AS mean, min(value) AS lowest, max(value) AS highest FROM events GROUP BY event_type""")
def agg_basic(spark, folder):
    e = table(spark, folder, "events")
    return e.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count(F.nullif(F.col("value"), F.lit(6.55))).alias("value_count"),
        F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("lowest"), F.max("value").alias("highest"))


@query("""SELECT event_type, round(stddev_samp(value), 6) AS deviation, max(value) - min(value) AS spread
    FROM events GROUP BY event_type""")
def agg_stats(spark, folder):
    p = numeric_profile(table(spark, folder, "events"), "value", ["event_type"])
    return p.select("event_type", F.round("deviation", 6).alias("deviation"), "spread")


@query("""SELECT count(*) AS row_count, CAST(count_if(value > 10) AS BIGINT) AS large_count, round(sum(value), 4) AS total,
    round(avg(value), 6) AS mean FROM events""")
def agg_global(spark, folder):
    return table(spark, folder, "events").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("value") > 10).alias("large_count"),
        F.round(F.sum("value"), 4).alias("total"), F.round(F.avg("value"), 6).alias("mean"))


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS total,
    round(avg(l_quantity), 6) AS mean, count(*) AS n FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2""")
def agg_group(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("total"), F.round(F.avg("l_quantity"), 6).alias("mean"),
        F.count(F.lit(1)).alias("n")).orderBy("l_returnflag", "l_linestatus")


@query("""SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS price_sum,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(27,4)) AS discount_sum
    FROM lineitem GROUP BY l_suppkey""")
def agg_decimal(spark, folder):
    price, discount = F.col("l_extendedprice").cast("decimal(12,2)"), F.col("l_discount").cast("decimal(4,2)")
    return table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.sum(price).cast("decimal(22,2)").alias("price_sum"),
        F.sum(price * discount).cast("decimal(27,4)").alias("discount_sum"))


@query()
def median_approx(spark, folder):
    """Approximate by design, so there is no equal SQL; a test bounds its rank error."""
    return numeric_profile(table(spark, folder, "events"), "value", ["event_type"]).select("event_type", "median")


@query("""SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS row_number
    FROM events""")
def row_number(spark, folder):
    """Five groups only: each is numbered day by day and the days are added up."""
    e = table(spark, folder, "events").select("event_type", "event_id", "ts")
    rows = row_numbers(e, ["event_type"], [F.col("ts"), F.col("event_id")], F.to_date("ts"))
    return rows.select("event_type", "event_id", "row_number")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_keys(spark, folder):
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber").distinct()


@query("""SELECT l_suppkey, l_returnflag, l_linestatus FROM lineitem GROUP BY ALL""")
def dedup_subset(spark, folder):
    line = table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_quantity")
    return line.dropDuplicates(["l_suppkey", "l_returnflag", "l_linestatus"]).drop("l_quantity")


RUNS = """SELECT 'events' AS table_name, event_type || '_' || user_id AS filename, 'csv' AS input_format,
    'MERGE' AS ingestion_mode, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CAST(user_id AS BIGINT) AS error_count, 'dev' AS env, value AS duration, ts AS log_ts, event_id AS row_count,
    CAST(3 AS BIGINT) AS column_count FROM events"""


def runs(spark, folder):
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.lit("events").alias("table_name"), F.concat_ws("_", kind, "user_id").alias("filename"),
        F.lit("csv").alias("input_format"), F.lit("MERGE").alias("ingestion_mode"),
        F.when(kind == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("user_id").cast("bigint").alias("error_count"), F.lit("dev").alias("env"),
        F.col("value").alias("duration"), F.col("ts").alias("log_ts"), F.col("event_id").alias("row_count"),
        F.lit(3).cast("bigint").alias("column_count"))


FAULTS = """SELECT 'events' AS table_name, event_type || '_' || user_id AS filename, event_id AS line_id,
    event_type AS column_name, CASE WHEN user_id % 3 > 0 THEN 'Invalid ' || event_type END AS error_message,
    CAST(user_id AS BIGINT) AS error_count, 'internal' AS zone, 'dev' AS env, ts AS log_ts FROM events"""


def faults(spark, folder):
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.lit("events").alias("table_name"), F.concat_ws("_", kind, "user_id").alias("filename"),
        F.col("event_id").alias("line_id"), kind.alias("column_name"),
        F.when(F.col("user_id") % 3 > 0, F.concat(F.lit("Invalid "), kind)).alias("error_message"),
        F.col("user_id").cast("bigint").alias("error_count"), F.lit("internal").alias("zone"),
        F.lit("dev").alias("env"), F.col("ts").alias("log_ts"))


@query(f"""SELECT {', '.join(reports.RUN_COLUMNS)} FROM ({RUNS}) ORDER BY log_ts DESC, table_name, filename LIMIT 50""")
def recent_runs(spark, folder):
    return reports.recent_runs(runs(spark, folder))


@query(f"""SELECT {', '.join(reports.ERROR_COLUMNS)} FROM ({FAULTS})
    ORDER BY log_ts DESC, table_name, filename, line_id, column_name LIMIT 100""")
def recent_errors(spark, folder):
    return reports.recent_errors(faults(spark, folder))


@query(f"""SELECT table_name, input_format, filename, row_count, column_count, status, error_count, env, duration, log_ts
    FROM ({RUNS}) ORDER BY log_ts DESC, table_name, filename LIMIT 20""")
def latest_runs_view(spark, folder):
    reports.log_views(runs(spark, folder), faults(spark, folder))
    return reports.latest_runs(spark)


@query(f"""SELECT table_name, filename, column_name, error_message, error_count, zone, env, log_ts FROM ({FAULTS})
    WHERE error_message IS NOT NULL""")
def described_errors_view(spark, folder):
    reports.log_views(runs(spark, folder), faults(spark, folder))
    return reports.described_errors(spark)


@query(f"""SELECT status, env, count(*) AS count FROM ({RUNS}) GROUP BY 1, 2""")
def status_stats(spark, folder):
    return reports.status_stats(runs(spark, folder))


HISTORY = """SELECT CASE WHEN event_type <> 'view' THEN event_type || '_' || user_id END AS "FILE_NAME_RECEIVED",
    CASE WHEN event_type <> 'error' THEN date_trunc('hour', ts) END AS "FILE_PROCESS_DATE", user_id,
    CAST(year(ts) AS INTEGER) AS yyyy, CAST(month(ts) AS INTEGER) AS mm, CAST(day(ts) AS INTEGER) AS dd FROM events"""


def history(spark, folder):
    """Events as a history table: repeated rows, some without a processing date or file name."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.when(kind != "view", F.concat_ws("_", kind, "user_id")).alias("FILE_NAME_RECEIVED"),
        F.when(kind != "error", F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("FILE_PROCESS_DATE"), "user_id",
        F.year("ts").alias("yyyy"), F.month("ts").alias("mm"), F.dayofmonth("ts").alias("dd"))


@query(HISTORY)
def bronze(spark, folder):
    return medallion.bronze(history(spark, folder))


@query(f"""SELECT DISTINCT * FROM ({HISTORY}) WHERE "FILE_PROCESS_DATE" IS NOT NULL""")
def silver(spark, folder):
    return medallion.silver(history(spark, folder))


@query(f"""WITH s AS (SELECT DISTINCT * FROM ({HISTORY}) WHERE "FILE_PROCESS_DATE" IS NOT NULL)
    SELECT 'valid_date' AS expectation, count(*) AS total_rows, CAST(count_if("FILE_PROCESS_DATE" IS NULL) AS BIGINT) AS violations FROM s
    UNION ALL SELECT 'valid_filename', count(*), CAST(count_if("FILE_NAME_RECEIVED" IS NULL) AS BIGINT) FROM s""")
def silver_expectations(spark, folder):
    return medallion.silver_violations(history(spark, folder))


@query(f"""WITH s AS (SELECT DISTINCT * FROM ({HISTORY}) WHERE "FILE_PROCESS_DATE" IS NOT NULL)
    SELECT yyyy, mm, dd, "FILE_NAME_RECEIVED", count(*) AS total_records, min("FILE_PROCESS_DATE") AS first_processed,
    max("FILE_PROCESS_DATE") AS last_processed FROM s GROUP BY ALL ORDER BY yyyy DESC, mm DESC, dd DESC""")
def gold(spark, folder):
    return medallion.gold(medallion.silver(history(spark, folder)))
