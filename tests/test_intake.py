import datetime as dt

import pytest

from tests.conftest import values
from tidegate.plans.intake import Layout, run
from tidegate.rules import ColumnRule, TableRule
from tidegate.sinks.tables import CurrentTable, read_table

COLUMNS = [ColumnRule("id", "site", field_type="INTEGER", is_nullable=False, is_merge_key=True),
           ColumnRule("name", "site", transformation_type="uppercase", is_nullable=False, error_action="LOG_ONLY"),
           ColumnRule("date", "site", field_type="DATE", default_invalid="2000-01-01", is_start_validity=True)]


def site(mode="MERGE", **more):
    return TableRule("site", **({"filename_pattern": "site_<yyyy><mm><dd>_<hhmmss>.csv", "header": "FIRST LINE",
                                 "ingestion_mode": mode, "merge_files": True} | more))


@pytest.fixture
def layout(put, tmp_path):
    return Layout(put.inbox, str(tmp_path / "lake"))


def statuses(log):
    return {(r["table_name"], r["filename"]): (r["status"], r["error_message"], r["row_count"]) for r in log.collect()}


def test_whole_load(spark, put, layout):
    put("site_20251201_120001.csv", "id,name,date\n1, alice ,2025-01-01\n2,bob,01/12/2025\n2,bobby,oops\n,x,2025-02-01\n3,,\n")
    put("site_20251202.csv", "id,name,date\n1,ALICE2,2025-03-01\n9,zed,20250101\n")
    log = run(spark, [site()], COLUMNS, layout, dt.datetime(2025, 12, 5))
    assert statuses(log) == {("site", "site_20251201_120001.csv"): ("SUCCESS", "7", 5), ("site", "site_20251202.csv"): ("SUCCESS", "0", 2)}
    state = CurrentTable(spark, layout.table(site(), "last")).read()
    assert sorted(values(state, "id", "name", "FILE_NAME_RECEIVED", "dd"), key=repr) == sorted([
        (1, "ALICE2", "site_20251202", 2), (2, "BOB", "site_20251201_120001", 1), (3, None, "site_20251201_120001", 1),
        (9, "ZED", "site_20251202", 2), (None, "X", "site_20251201_120001", 1)], key=repr)
    history = read_table(spark, layout.table(site(), "all"))
    assert history.count() == 7
    errors = read_table(spark, layout.quality_log)
    assert sorted(values(errors, "error_message", "line_id", "error_count"), key=repr)[:6] == sorted([
        ("DUPLICATE_KEY", None, 2), ("INVALID_DATE", 3, 1), ("LOG_ONLY", None, 1), ("NULL_KEY", None, 1),
        ("NULL_VALUE", 4, 1), ("NULL_VALUE", 5, 1)], key=repr)
    # Every error line is a line of its file.
    lines = {(r["FILE_NAME_RECEIVED"] + ".csv", r["line_id"]) for r in history.collect()}
    assert {(r["filename"], r["line_id"]) for r in errors.filter("line_id IS NOT NULL").collect()} <= lines
    put("site_20251203.csv", "id,name,date\n1,newer,2026-03-01\n2,bob,01/12/2025\n9,older,20240101\n10,n,20240101\n")
    run(spark, [site()], COLUMNS, layout)
    state = CurrentTable(spark, layout.table(site(), "last")).read()
    # The first two files are still in the inbox; their row without a key comes again, since it matches nothing.
    assert sorted(values(state.filter("id IS NOT NULL"), "id", "name")) == [
        (1, "NEWER"), (2, "BOB"), (3, None), (9, "ZED"), (10, "N")]
    assert state.filter("id IS NULL").count() == 2
    assert read_table(spark, layout.execution_log).count() == 5


def test_first_file_only_without_merging(spark, put, layout):
    put("site_20251202.csv", "id,name,date\n2,b,20250101\n")
    put("site_20251201.csv", "id,name,date\n1,a,20250101\n")
    log = run(spark, [site("FULL_SNAPSHOT", merge_files=False)], COLUMNS, layout)
    got = statuses(log)
    assert got[("site", "site_20251201.csv")][0] == "SUCCESS" and got[("site", "site_20251202.csv")][0] == "SKIPPED" and len(got) == 2
    state = CurrentTable(spark, layout.table(site(), "last")).read()
    assert values(state, "id") == [1] and "FILE_PROCESS_DATE" not in state.columns


def test_snapshot_append_and_key_replace(spark, put, layout):
    path = put("site_20251201.csv", "id,name,date\n1,a,20250101\n2,b,20250101\n")
    expected = {"OVERWRITE": [2, 3], "APPEND": [1, 2, 2, 3], "FULL_KEY_REPLACE": [1, 2, 3], "odd": [1, 2, 2, 3]}
    for mode in expected:
        rule = site(mode, zone=mode.lower())
        run(spark, [rule], COLUMNS, layout)
    with open(path, "w") as f:
        f.write("id,name,date\n2,B,20250101\n3,c,20250101\n")
    for mode, ids in expected.items():
        rule = site(mode, zone=mode.lower())
        log = run(spark, [rule], COLUMNS, layout)
        got = sorted(values(CurrentTable(spark, layout.table(rule, "last")).read(), "id"))
        assert got == ids, mode
    assert log.filter("status = 'WARN'").count() == 1


def test_failures_are_logged(spark, put, layout):
    put("short_20251201.csv", "id,name\n1,a\n")
    put("empty_20251201.csv", "")
    put("two_20251201.csv", "a,b\n1,2\n")
    put("late_20251340.csv", "id,name,date\n1,a,20250101\n")
    columns = COLUMNS + [ColumnRule(r.column_name, t, r.field_type) for t in ("short", "empty", "two", "late") for r in COLUMNS]
    tables = [TableRule("none", filename_pattern="none_<yyyy>.csv"),
              TableRule("fmt", filename_pattern="x.xlsx", input_format="excel"),
              TableRule("sep", filename_pattern="x.csv", delimiter="ab"),
              TableRule("short", filename_pattern="short_<yyyy><mm><dd>.csv", header="FIRST LINE"),
              TableRule("empty", filename_pattern="empty_<yyyy><mm><dd>.csv", header="FIRST LINE", ignore_empty=False),
              TableRule("two", filename_pattern="two_<yyyy><mm><dd>.csv", header="HEADER USE"),
              TableRule("late", filename_pattern="late_<yyyy><mm><dd>.csv", header="FIRST LINE", ingestion_mode="APPEND")]
    log = statuses(run(spark, tables, columns, layout))
    assert {s for s, *_ in log.values()} == {"FAILED"}
    messages = {table: message for (table, _), (_, message, _) in log.items()}
    assert messages["none"] == "No file matched none_<yyyy>.csv" and messages["fmt"] == "Unsupported format excel"
    assert messages["sep"].startswith("Delimiter error") and "Missing columns ['date']" in messages["short"]
    assert messages["empty"].startswith("Empty file") and "3 columns configured, 2 in the file" in messages["two"]
    assert messages["late"] == "INVALID DATE in filename"
    errors = read_table(spark, layout.quality_log)
    assert ("short", "date", "MISSING_COLUMN") in values(errors, "table_name", "column_name", "error_type")


def test_allowed_missing_columns(spark, put, layout):
    put("site_20251201.csv", "id,name,extra\n1,a, more \n")
    run(spark, [site("APPEND", delete_columns_allowed=True)], COLUMNS, layout)
    row = CurrentTable(spark, layout.table(site(), "last")).read().first()
    assert (row["id"], row["extra"], row["date"]) == (1, "more", dt.date(2000, 1, 1))


@pytest.mark.parametrize("tolerance,status", [("10%", "FAILED"), ("2", "SUCCESS")])
def test_corrupt_files_and_quarantine(spark, put, layout, tolerance, status):
    put("site_20251201.csv", "1,a,20250101\n2\n3,c\n4,d,20250101\n")
    put("site_20251202.csv", "5,e,20250101\n")
    rule = site("APPEND", header=None, reject_tolerance=tolerance, invalid_lines_generate=True)
    log = statuses(run(spark, [rule], COLUMNS, layout))
    assert log[("site", "site_20251201.csv")][0] == status and log[("site", "site_20251202.csv")][0] == "SUCCESS"
    ids = sorted(values(CurrentTable(spark, layout.table(rule, "last")).read(), "id"))
    assert ids == ([5] if status == "FAILED" else [1, 4, 5])
    bad = spark.read.parquet(layout.quarantine("site"))
    assert sorted(values(bad, "line_id", "record")) == [(2, "2"), (3, "3,c")]


def test_refused_rows_are_logged_whole(spark, put, layout):
    put("site_20251201.csv", "id,name,date\n1,a,20250101\n,,20250101\n3,c,20250101\n")
    columns = [ColumnRule(r.column_name, "site", r.field_type, is_nullable=False) for r in COLUMNS]
    run(spark, [site("APPEND")], columns, layout)
    assert sorted(values(CurrentTable(spark, layout.table(site(), "last")).read(), "id")) == [1, 3]
    row = read_table(spark, layout.quality_log).filter("error_type = 'INVALID_ROW'").first()
    assert row["line_id"] == 2 and row["raw_value"] == '{"date":"2025-01-01"}'


def test_fixed_width_load(spark, put, layout):
    put("fx_20251201.txt", "0001alice20250101\n0002bob  20250102\n")
    columns = [ColumnRule("id", "fx", "INT", column_size=4, field_order=1), ColumnRule("name", "fx", column_size=5, field_order=2),
               ColumnRule("day", "fx", "DATE", column_size=8, field_order=3)]
    rule = TableRule("fx", filename_pattern="fx_<yyyy><mm><dd>.txt", input_format="fixed", ingestion_mode="FULL_SNAPSHOT")
    run(spark, [rule], columns, layout)
    assert sorted(values(CurrentTable(spark, layout.table(rule, "last")).read(), "id", "name", "day")) == [
        (1, "alice", dt.date(2025, 1, 1)), (2, "bob", dt.date(2025, 1, 2))]


def test_headers_are_judged_file_by_file(spark, put, layout):
    put("site_20251201.csv", "id,name,date\n1,a,20250101\n")
    put("site_20251202.csv", "date;id\n")
    put("site_20251203.csv", "date,name,id\n20250103,c,3\n")
    put("site_20251204.csv", "id,name\n4,d\n")
    log = statuses(run(spark, [site("APPEND")], COLUMNS, layout))
    assert {f: s for (_, f), (s, *_) in log.items()} == {"site_20251201.csv": "SUCCESS", "site_20251202.csv": "FAILED",
                                                         "site_20251203.csv": "SUCCESS", "site_20251204.csv": "FAILED"}
    state = CurrentTable(spark, layout.table(site(), "last")).read()
    assert sorted(values(state, "id", "name", "date")) == [(1, "A", dt.date(2025, 1, 1)), (3, "C", dt.date(2025, 1, 3))]
    lost = read_table(spark, layout.quality_log).filter("error_type = 'MISSING_COLUMN'")
    assert ("site_20251204.csv", "date") in values(lost, "filename", "column_name")
    wide = TableRule("wide", filename_pattern="site_<yyyy><mm><dd>.csv", header="HEADER USE", ingestion_mode="APPEND", merge_files=True)
    log = statuses(run(spark, [wide], [ColumnRule(c, "wide") for c in ("a", "b", "c")], layout))
    assert sorted(s for s, *_ in log.values()) == ["FAILED", "FAILED", "SUCCESS", "SUCCESS"]


@pytest.mark.parametrize("mode", ["FULL_SNAPSHOT", "MERGE"])
def test_a_refused_delivery_changes_nothing(spark, put, layout, mode):
    path = put("site_20251201.csv", "1,a,20250101\n2,b,20250101\n")
    rule = site(mode, header=None)
    run(spark, [rule], COLUMNS, layout)
    current = CurrentTable(spark, layout.table(rule, "last"))
    before = current.latest()
    with open(path, "w") as f:
        f.write("1\n2\n")
    assert statuses(run(spark, [rule], COLUMNS, layout))[("site", "site_20251201.csv")][0] == "FAILED"
    assert current.latest() == before and sorted(values(current.read(), "id")) == [1, 2]


def test_an_empty_state_is_an_empty_table(spark, put, layout):
    put("site_20251201.csv", "id,name,date\n,a,20250101\n")
    columns = [ColumnRule("id", "site", "INTEGER", is_nullable=False, error_action="REJECT"), *COLUMNS[1:]]
    run(spark, [site("FULL_SNAPSHOT")], columns, layout)
    state = CurrentTable(spark, layout.table(site(), "last")).read()
    assert state.count() == 0 and {"id", "name", "date", "yyyy"} <= set(state.columns)


def test_one_bad_table_does_not_stop_the_others(spark, put, layout):
    put("site_20251201.csv", "id,name,date\n1,a,20250101\n")
    bad = [ColumnRule("id", "badly", transformation_type="regex_replace", transform_pattern="(")] if "transform_pattern" in ColumnRule.__dataclass_fields__ else []
    tables = [TableRule("nokeys", filename_pattern="site_<yyyy><mm><dd>.csv", header="FIRST LINE", ingestion_mode="MERGE"), site("MERGE")]
    log = statuses(run(spark, tables, COLUMNS + [ColumnRule("id", "nokeys")] + bad, layout))
    assert log[("nokeys", "N/A")][:2] == ("FAILED", "MERGE needs merge keys") and log[("site", "site_20251201.csv")][0] == "SUCCESS"
    assert read_table(spark, layout.table(tables[0], "all")) is None
    assert read_table(spark, layout.execution_log).count() == 2


def test_file_names_are_decoded_and_bad_ones_logged(spark, put, layout):
    put("my site+x_20251201.csv", "id,name,date\n1,a,20250101\n,b,20250101\n")
    put("my site+x_20251399.csv", "id,name,date\n1,a,20250101\n")
    rule = site("APPEND", filename_pattern="my site+x_<yyyy><mm><dd>.csv")
    log = statuses(run(spark, [rule], COLUMNS, layout))
    assert {f for _, f in log} == {"my site+x_20251201.csv", "my site+x_20251399.csv"}
    assert values(CurrentTable(spark, layout.table(rule, "last")).read(), "FILE_NAME_RECEIVED")[0] == "my site+x_20251201"
    errors = read_table(spark, layout.quality_log)
    assert errors.filter("uri IS NULL").count() == 0 and values(errors.filter("error_type = 'FILE_REJECTED'"), "raw_value") == ["my site+x_20251399.csv"]


def test_no_line_is_shuffled_by_file(spark, put, layout):
    from tidegate.operators.actions import apply_actions
    from tidegate.operators.cleanse import cleanse

    df = spark.createDataFrame([("f1", "1"), ("f2", None)], "_file string, id string")
    kept = apply_actions(cleanse(df, [ColumnRule("id", is_nullable=False)]), [ColumnRule("id", is_nullable=False)], by="_file")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
