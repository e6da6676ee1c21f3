import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import values
from tidegate.plans import intake
from tidegate.plans.intake import Layout, run
from tidegate.rules import ColumnRule, TableRule
from tidegate.sinks.ledger import Change, Ledger, ledger_path
from tidegate.sinks.schema import TypeConflict, evolved, wider
from tidegate.sinks.tables import CurrentTable, StoredTable, read_table, stamp

RULES = [ColumnRule("id", "site", field_type="LONG", is_merge_key=True), ColumnRule("name", "site"),
         ColumnRule("day", "site", field_type="DATE", is_start_validity=True)]
AT = dt.datetime(2025, 12, 5)


def site(mode="MERGE", **more):
    return TableRule("site", **({"filename_pattern": "site_<yyyy><mm><dd>.csv", "header": "FIRST LINE", "ingestion_mode": mode, "merge_files": True} | more))


@pytest.fixture
def layout(put, tmp_path):
    return Layout(put.inbox, str(tmp_path / "lake"), once=True)


def rows_of(spark, layout, rule, suffix, *names):
    return sorted(values(read_table(spark, layout.table(rule, suffix)), *names), key=repr)


def files_below(path):
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def struct(**kinds):
    return T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in kinds.items()))


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("float", "double", "double"), ("int", "double", "double"),
    ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("int", "decimal(5,2)", "decimal(12,2)"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("void", "string", "string"), ("bigint", "double", None), ("string", "bigint", None), ("date", "timestamp", None),
    ("decimal(38,0)", "decimal(38,10)", None), ("boolean", "int", None)])
def test_types_that_go_together(spark, a, b, want):
    kinds = [struct(c=k)["c"].dataType for k in (a, b)]
    for pair in (kinds, kinds[::-1]):
        found = wider(*pair)
        assert (found.simpleString() if found else None) == want


def test_evolved_schemas(spark):
    stored = struct(id="int", Name="string", yyyy="string")
    assert evolved(stored, struct(NAME="string", id="bigint", yyyy="int", more="date"), ("yyyy",)).simpleString() == \
        "struct<id:bigint,Name:string,yyyy:string,more:date>"
    with pytest.raises(TypeConflict, match="Column id is string, the stored one int"):
        evolved(stored, struct(id="string"))
    assert evolved(None, struct(id="string")) == struct(id="string")


@pytest.mark.parametrize("old,new,value", [("int", "bigint", 2**40), ("int", "double", 0.5), ("decimal(6,2)", "decimal(12,4)", None), ("date", "timestamp_ntz", None)])
def test_files_written_earlier_are_read_under_a_wider_type(spark, tmp_path, old, new, value):
    table = CurrentTable(spark, str(tmp_path / "t_last"))
    sample = {"date": "DATE '2025-01-02'", "decimal(6,2)": "1.25"}.get(old, "7")
    other = {"timestamp_ntz": "TIMESTAMP_NTZ '2025-01-02 03:04:05'", "decimal(12,4)": "12345678.1234"}.get(new, str(value))
    for kind, text in ((old, sample), (new, other), (old, sample)):
        table.append(stamp(spark.range(1).selectExpr(f"CAST({text} AS {kind}) AS v"), {"yyyy": 2025}, None, AT))
    got = table.read()
    assert dict(got.dtypes)["v"] == new
    want = spark.sql(f"SELECT CAST(CAST({sample} AS {old}) AS {new}) AS a, CAST({other} AS {new}) AS b").first()
    assert sorted(values(got, "v")) == sorted([want["a"], want["a"], want["b"]])


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, ledger_path(f"{tmp_path}/t_all"))
    assert ledger.path == ledger_path(f"{tmp_path}/t_last") and ledger.content("t") is None and ledger.version() == 0
    a, b = struct(v="int"), struct(v="bigint")
    ledger.commit("one", {"t": Change(a, ["p1"], True)})
    ledger.commit("two", {"t": Change(b, ["p2", "p3"], True), "u": Change(a, [])})
    assert ledger.content("t") == (b, ["p1", "p2", "p3"]) and ledger.content("u") == (a, [])
    ledger.commit("three", {"t": Change(a, ["p3", "p4"])})
    ledger.commit("four", {"t": Change(a, ["p5"], True)})
    assert ledger.content("t") == (a, ["p3", "p4", "p5"]) and ledger.version() == 4
    files = spark.createDataFrame([("f", 1, AT)], "_file string, length long, modified timestamp")
    ledger.note_files(files, "lost")
    assert ledger.loaded_files().count() == 0
    ledger.note_files(files, "four")
    assert ledger.loaded_files().count() == 1


@pytest.mark.parametrize("mode,broken", [("MERGE", "apply_mode"), ("APPEND", "append_log"), ("FULL_SNAPSHOT", "note_files")])
def test_a_failed_load_leaves_nothing_and_can_be_repeated(spark, put, layout, monkeypatch, mode, broken):
    rule = site(mode)
    put("site_20251201.csv", "id,name,day\n1,a,20250101\n2,b,20250101\n")
    run(spark, [rule], RULES, layout, AT)
    before = [rows_of(spark, layout, rule, s, "id", "name", "dd") for s in ("all", "last")]
    put("site_20251202.csv", "id,name,day\n2,B,20250301\n3,c,20250301\n")
    owner = Ledger if broken == "note_files" else intake
    fails = iter([True])
    whole = getattr(owner, broken)

    def fail(*args, **more):
        # The log of runs is written after the loads.
        if (broken != "append_log" or args[1] == layout.quality_log) and next(fails, False):
            raise RuntimeError("disk full")
        return whole(*args, **more)

    monkeypatch.setattr(owner, broken, fail)
    log = run(spark, [rule], RULES, layout, AT)
    assert [(r["status"], r["error_message"], r["row_count"]) for r in log.collect()] == [("FAILED", "RuntimeError: disk full", 0)]
    assert [rows_of(spark, layout, rule, s, "id", "name", "dd") for s in ("all", "last")] == before
    run(spark, [rule], RULES, layout, AT)
    assert rows_of(spark, layout, rule, "all", "id", "name", "dd") == [(1, "a", 1), (2, "B", 2), (2, "b", 1), (3, "c", 2)]
    want = {"APPEND": 4, "MERGE": 3, "FULL_SNAPSHOT": 2}[mode]
    assert len(rows_of(spark, layout, rule, "last", "id")) == want
    again = run(spark, [rule], RULES, layout, AT)
    assert {(r["status"], r["error_message"]) for r in again.collect()} == {("SKIPPED", "Already loaded")}
    assert len(rows_of(spark, layout, rule, "all", "id")) == 4


def test_a_changed_file_is_a_new_one_and_a_refused_one_comes_again(spark, put, layout):
    rule = site("APPEND")
    path = put("site_20251201.csv", "id,name,day\n1,a,20250101\n")
    put("site_20251202.csv", "id,day\n1,20250101\n")
    assert {r["filename"]: r["status"] for r in run(spark, [rule], RULES, layout, AT).collect()} == {"site_20251201.csv": "SUCCESS", "site_20251202.csv": "FAILED"}
    with open(path, "a") as f:
        f.write("2,b,20250101\n")
    got = {r["filename"]: r["status"] for r in run(spark, [rule], RULES, layout, AT).collect()}
    assert got == {"site_20251201.csv": "SUCCESS", "site_20251202.csv": "FAILED"}
    assert rows_of(spark, layout, rule, "all", "id") == [1, 1, 2]


def test_a_load_deletes_what_it_staged(spark, put, layout, tmp_path, monkeypatch):
    import tidegate.session as session

    made = str(tmp_path / "work")
    monkeypatch.setattr(session, "work_dir", lambda spark: made)
    put("site_20251201.csv", "id,name,day\n1,a,20250101\n")
    log = intake.load_table(spark, site(), RULES, layout, AT)
    assert [n.split("-")[0] for n in os.listdir(made)] == ["runs"] and log.first()["status"] == "SUCCESS"
    assert rows_of(spark, layout, site(), "last", "id", "name") == [(1, "a")]


def test_a_column_of_another_type_fails_before_anything_is_written(spark, put, layout):
    put("site_20251201.csv", "id,name,day\n1,a,20250101\n")
    run(spark, [site()], RULES, layout, AT)
    put("site_20251202.csv", "id,name,day\nx2,b,20250301\n")
    texts = [ColumnRule("id", "site", is_merge_key=True), *RULES[1:]]
    row = run(spark, [site()], texts, layout, AT).filter("status = 'FAILED'").first()
    assert row["error_message"] == "TypeConflict: Column id is string, the stored one bigint"
    assert rows_of(spark, layout, site(), "all", "id", "name") == [(1, "a")] == rows_of(spark, layout, site(), "last", "id", "name")


@pytest.mark.parametrize("mode", ["MERGE", "FULL_KEY_REPLACE"])
def test_untouched_days_keep_their_files(spark, put, layout, mode):
    rule = site(mode)
    for day in range(1, 6):
        put(f"site_2025120{day}.csv", "id,name,day\n" + "".join(f"{10 * day + i},n{day},20250101\n" for i in range(5)))
    run(spark, [rule], RULES, layout, AT)
    current = CurrentTable(spark, layout.table(rule, "last"))
    before, folders = files_below(current.path), current.latest()[1]
    assert len(folders) == 5
    put("site_20251206.csv", "id,name,day\n31,new,20250301\n99,new,20250301\n,none,20250301\n")
    run(spark, [rule], RULES, layout, AT)
    kept = [p for p in current.latest()[1] if p in folders]
    assert len(kept) == 4 and not any("dd=3" in p for p in kept) and files_below(current.path).items() >= before.items()
    want = sorted((10 * d + i, f"n{d}", d) for d in range(1, 6) for i in range(5) if (d, i) != (3, 1))
    assert rows_of(spark, layout, rule, "last", "id", "name", "dd") == sorted([*want, (31, "new", 6), (99, "new", 6), (None, "none", 6)], key=repr)
    # Only the day that holds the key is read for its rows.
    scan = current.read([p for p in folders if "dd=3" in p])
    assert scan.select("dd").distinct().collect() == [(3,)]


def test_the_catalog_shows_committed_days(spark, put, layout, tmp_path):
    name = f"lake_{tmp_path.name.replace('-', '_')}"
    kept = Layout(layout.inbox, layout.root, database=name, once=True)
    try:
        for day, text in ((1, "1,a,20250101\n2,b,20250101\n"), (2, "2,B,20250301\n3,c,20250301\n")):
            put(f"site_2025120{day}.csv", f"id,name,day\n{text}")
            run(spark, [site()], RULES, kept, AT)
        StoredTable(spark, kept.table(site(), "last")).put(stamp(spark.createDataFrame([(7, "lost")], "id long, name string"), {"yyyy": 2025}, None, AT), "lost")
        assert sorted(values(spark.table(f"{name}.site_last"), "id", "name", "dd")) == [(1, "a", 1), (2, "B", 2), (3, "c", 2)]
        assert sorted(values(spark.table(f"{name}.site_all"), "id", "name")) == [(1, "a"), (2, "B"), (2, "b"), (3, "c")]
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_one_scan_for_every_order_of_the_columns(spark, put, layout):
    import itertools

    rule = site("APPEND")
    for day, order in enumerate(itertools.permutations(["id", "name", "day"]), 1):
        cells = {"id": str(day), "name": f"n{day}", "day": "20250101"}
        put(f"site_2025120{day}.csv", ",".join(order) + "\n" + ",".join(cells[c] for c in order) + "\n")
    raw, refused = intake._read_by_header(spark, rule, RULES, layout.inbox, "site_*.csv")
    assert str(raw._jdf.queryExecution().optimizedPlan().toString()).count("Relation [_c0") == 1 and refused.count() == 0
    assert sorted(values(raw, "id", "name", "day")) == [(str(d), f"n{d}", "20250101") for d in range(1, 7)]


@pytest.mark.parametrize("fmt,head,names", [
    ("csv", "id,name,day", ["id", "name", "day"]), ("csv", "ID,,x,", ["ID", "_c1", "x", "_c3"]), ("csv", "a,A,b", ["a0", "A1", "b"]),
    ("csv_quote", '"i,d",name', ["i,d", "name"]), ("csv", "one", ["one"]), ("csv", '"q","r"', ["q", "r"])])
def test_names_of_headers(spark, tmp_path, fmt, head, names):
    from tidegate.sources.delimited import csv_reader, file_heads, judged

    (tmp_path / "f.csv").write_text(head + "\n" + ",".join("x" * len(names)) + "\n")
    rule = TableRule("t", input_format=fmt, header="FIRST LINE", delete_columns_allowed=True)
    row = judged(file_heads(spark, str(tmp_path), rule), rule, ["id"]).first()
    assert row["names"] == names == csv_reader(spark, rule).option("header", True).csv(str(tmp_path)).columns and row["width"] == len(names)
