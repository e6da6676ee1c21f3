import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidegate.plans import medallion, reports
from tidegate.session import broadcast_if_small, measured_bytes, tune
from tidegate.sinks.catalog import register_table
from tidegate.sinks.logs import EXECUTION_LOG, QUALITY_LOG, append_log, execution_rows, quality_rows, run_row
from tidegate.sinks.tables import CurrentTable, balanced, output_path, partition_types, read_table, stamp, write_partitioned

AT = dt.datetime(2025, 12, 3, 4, 5, 6)


def test_stamp(spark):
    df = spark.createDataFrame([(1, 2)], "id int, ID int")
    got = stamp(df, {"yyyy": 2025, "mm": 12, "dd": 1}, "/x/site_20251201.csv", AT)
    assert got.columns == ["FILE_NAME_RECEIVED", "FILE_PROCESS_DATE", "id", "yyyy", "mm", "dd"]
    assert tuple(got.first()) == ("site_20251201", AT, 1, 2025, 12, 1)
    assert tuple(stamp(df, {"yyyy": 2025, "mm": 2, "dd": None}, None, AT).select("yyyy", "mm", "dd").first()) == (2025, 2, 1)
    assert tuple(stamp(df, {}, None, AT).select("yyyy", "mm", "dd").first()) == (2025, 12, 3)


def test_partitioned_append_and_evolution(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_table(spark, path) is None
    df = spark.createDataFrame([(1,)], "id int")
    write_partitioned(stamp(df, {"yyyy": 2025, "mm": 1, "dd": 2}, None, AT), path)
    wider = df.withColumn("extra", F.lit("x"))
    write_partitioned(stamp(wider, {"yyyy": 2025, "mm": 1, "dd": 3}, None, AT, {"yyyy": "string"}), path)
    stored = read_table(spark, path)
    assert sorted(values(stored, "dd", "extra")) == [(2, None), (3, "x")] or set(values(stored, "extra")) == {None, "x"}
    assert partition_types(stored) == {"yyyy": "int", "mm": "int", "dd": "int"}
    scan = stored.filter("dd = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dd" in scan


def test_balanced_write_keeps_rows(spark, tmp_path):
    df = stamp(spark.range(1000), {"yyyy": F.lit(2025), "mm": (F.col("id") % 3 + 1).cast("int")}, None, AT)
    write_partitioned(balanced(df), str(tmp_path / "b"))
    assert read_table(spark, str(tmp_path / "b")).groupBy("mm").count().count() == 3
    assert "REBALANCE" in balanced(df)._jdf.queryExecution().executedPlan().toString().upper()


def test_current_table(spark, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "t_last"))
    assert table.read() is None
    first = stamp(spark.createDataFrame([(1, "a")], "id int, v string"), {"yyyy": 2025}, None, AT)
    table.append(first)
    table.replace(table.read().withColumn("v", F.lit("b")))
    table.append(first.withColumn("w", F.lit(1)))
    got = sorted(values(table.read(), "v", "w"), key=repr)
    assert got == [("a", 1), ("b", None)] and table.ledger.version() == 3
    # What was written but never committed is not seen.
    table.put(first, "lost")
    assert table.read().count() == 2 and read_table(spark, table.path).count() == 2


def test_register(spark, tmp_path):
    for name in ("one", "two"):
        write_partitioned(stamp(spark.createDataFrame([(name,)], "v string"), {"yyyy": 2025}, None, AT), str(tmp_path / name))
    table = f"reg_{tmp_path.name.replace('-', '_')}"
    assert register_table(spark, table, str(tmp_path / "one"))
    assert not register_table(spark, table, str(tmp_path / "two"))
    assert not register_table(spark, table, str(tmp_path / "two"), if_exists="append")
    assert values(spark.table(table), "v") == ["one"]
    more = stamp(spark.createDataFrame([("later",)], "v string"), {"yyyy": 2026}, None, AT)
    write_partitioned(more, str(tmp_path / "one"))
    assert not register_table(spark, table, str(tmp_path / "one"))
    assert sorted(values(spark.table(table), "v")) == ["later", "one"]
    with pytest.raises(ValueError):
        register_table(spark, table, str(tmp_path / "two"), if_exists="errorexists")
    assert register_table(spark, table, str(tmp_path / "two"), if_exists="overwrite")
    assert values(spark.table(table), "v") == ["two"]
    with pytest.raises(ValueError):
        register_table(spark, table, "x", if_exists="maybe")
    spark.sql(f"DROP TABLE {table}")


def test_logs(spark, tmp_path):
    runs = run_row(spark, table_name="t", filename="f", status="SUCCESS", output_zone="secret", error_count=2, duration=1.5)
    append_log(execution_rows(runs, "dev", AT), str(tmp_path / "e"), files=1)
    log = read_table(spark, str(tmp_path / "e"))
    assert values(log, "table_name", "masking_applied", "yyyy", "env") == [("t", True, 2025, "dev")]
    assert {n.split()[0] for n in EXECUTION_LOG.split(", ")} == set(log.columns)
    errors = spark.createDataFrame([("x", 3, 5, 1)], "Error string, Count int, raw_value int, LINE_ID int")
    rows = quality_rows(errors, "t", "internal", "dev", AT)
    assert [c.split()[0] for c in QUALITY_LOG.split(", ")] == rows.columns
    assert values(rows, "table_name", "error_message", "error_count", "raw_value", "line_id") == [("t", "x", 3, "5", 1)]
    append_log(rows, str(tmp_path / "q"))
    append_log(rows.limit(0), str(tmp_path / "q"))
    assert read_table(spark, str(tmp_path / "q")).count() == 1
    kinds = quality_rows(spark.createDataFrame([("c", "MISSING_COLUMN")], "column_name string, error_type string"), "t", at=AT)
    assert values(kinds, "error_message", "error_count") == [("MISSING_COLUMN", 1)]


def test_reports(spark):
    log = spark.range(200).select(
        F.lit("t").alias("table_name"), F.concat(F.lit("f"), "id").alias("filename"), F.lit("csv").alias("input_format"),
        F.lit("m").alias("ingestion_mode"), F.when(F.col("id") % 4 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
        F.lit(0).alias("error_count"), F.lit(1).alias("row_count"), F.lit(1).alias("column_count"), F.lit("dev").alias("env"),
        F.lit(1.0).alias("duration"), F.timestamp_seconds("id").alias("log_ts"))
    recent = reports.recent_runs(log)
    assert recent.count() == 50 and recent.first()["filename"] == "f199"
    assert "TakeOrderedAndProject" in recent._jdf.queryExecution().executedPlan().toString()
    assert {r["status"]: r["count"] for r in reports.status_stats(log).collect()} == {"FAILED": 50, "SUCCESS": 150}
    quality = log.select("table_name", "filename", F.lit("c").alias("column_name"), F.lit(None).cast("string").alias("error_message"),
                         "error_count", F.lit("z").alias("zone"), "env", "log_ts")
    reports.log_views(log, quality)
    assert reports.latest_runs(spark).count() == 20 and reports.described_errors(spark).count() == 0
    assert reports.preview(log).count() == 10


def test_medallion(spark):
    rows = [("f1", AT, 1), ("f1", AT, 1), ("f1", AT, 2), (None, AT, 3), ("f2", None, 4)]
    history = spark.createDataFrame(rows, "FILE_NAME_RECEIVED string, FILE_PROCESS_DATE timestamp, v int").selectExpr(
        "*", "2025 AS yyyy", "12 AS mm", "v AS dd")
    silver = medallion.silver(medallion.bronze(history))
    assert silver.count() == 3
    assert {r["expectation"]: r["violations"] for r in medallion.silver_violations(history).collect()} == {"valid_date": 0, "valid_filename": 1}
    gold = medallion.gold(silver).collect()
    assert [(r["dd"], r["total_records"]) for r in gold] == [(3, 1), (2, 1), (1, 1)]


def test_paths_and_sizes(spark):
    assert output_path("/lake/", "dev", "internal", "v1", "t_all") == "/lake/dev/internal/v1/t_all"
    df = spark.range(100)
    assert 100 * 8 < measured_bytes(df) < 100 * 100
    hinted = broadcast_if_small(df, 10)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted and "broadcast" not in broadcast_if_small(df, None)._jdf.queryExecution().logical().toString()


def test_rows_of_one_day_are_not_sorted_for_a_write(spark):
    tune(spark)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "2"
