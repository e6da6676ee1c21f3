import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import values
from tidegate.functions import files, settings
from tidegate.functions.typing import spark_type
from tidegate.rules import ColumnRule, TableRule, load_column_rules, merge_keys, ordered, rules_frame


@pytest.mark.parametrize("raw,default,expected", [
    ("True", False, True), ("true", False, True), (1, False, True), ("yes", False, True), (" Oui ", False, True),
    ("False", True, False), ("non", True, False), ("", False, False), ("invalid", False, False), (None, True, True)])
def test_booleans(raw, default, expected):
    assert settings.as_bool(raw, default) is expected


@pytest.mark.parametrize("raw,expected", [(",", ","), (";", ";"), ("\\t", "\t"), ("\t", "\t"), ("tab", "\t"),
                                          ("pipe", "|"), (None, ","), ("  ", ","), ("'", "'")])
def test_delimiters(raw, expected):
    assert settings.delimiter(raw) == expected


def test_long_delimiter_is_refused():
    with pytest.raises(ValueError):
        settings.delimiter("invalid_delimiter")


@pytest.mark.parametrize("raw,flags,mode", [
    ("FIRST_LINE", (True, False), "names"), ("first line", (True, False), "names"),
    ("FIRST_LINE_ONLY", (True, True), "skip"), ("HEADER USE", (True, True), "skip"),
    ("NO_HEADER", (False, False), "none"), (None, (False, False), "none"), ("nan", (False, False), "none")])
def test_header_modes(raw, flags, mode):
    assert settings.header_flags(raw) == flags and settings.header_mode(raw) == mode


@pytest.mark.parametrize("raw,total,rows", [("10%", 100, 10), ("5%", 200, 10), ("0%", 100, 0), ("10", 100, 10),
                                            ("100%", 100, 100), ("0", 0, 0), ("5", 100, 5), ("0,5 %", 1000, 5),
                                            ("junk", 100, 0), ("", 100, 0), ("n/a", 100, 0)])
def test_tolerated_rows(spark, raw, total, rows):
    assert settings.allowed_rows(raw, total) == pytest.approx(rows)
    rate = spark.range(1).select(settings.tolerance_column(F.lit(raw), F.lit(total)).alias("r")).first()["r"]
    assert rate == pytest.approx(settings.tolerance(raw, total))


def test_types():
    assert [spark_type(t).simpleString() for t in ("STRING", "INTEGER", " date ", "LONG", "weird", None)] == \
        ["string", "int", "date", "bigint", "string", "string"]
    assert spark_type("DECIMAL") == T.DecimalType(38, 18)
    assert spark_type("DECIMAL", 10, 0) == T.DecimalType(10, 0)


def test_rules_from_any_heading(spark, tmp_path):
    a = ColumnRule.of({"Delta Table Name": "t", "Column Name": "id", "Field type": "int", "isMergeKey": "1",
                       "Is Nullable": "FALSE", "Default when invalid": float("nan"), "Field Order": 2.0})
    b = ColumnRule.of({"delta table name": "t", "COLUMN NAME": "since", "Field Type": "DATE",
                       "Is Special": "isStartValidity", "Enumeration List": "A, B", "Error action": "nan"})
    assert (a.field_type, a.is_nullable, a.default_invalid, a.field_order, a.is_merge_key) == ("INT", False, None, 2, True)
    assert b.is_start_validity and b.enumeration == ("A", "B") and b.error_action == "ICT_DRIVEN" and b.is_nullable
    assert merge_keys([a, b]) == ["id"] and [r.column_name for r in ordered([b, a])] == ["id", "since"]
    table = TableRule.of({"Delta Table Name": "none", "Input Header": "FIRST LINE", "Merge concomitant file": "oui",
                          "Input delimiter": ";"})
    assert table.table_name == "none" and table.merge_files and table.trim and table.reject_tolerance == "10%"
    path = tmp_path / "rules.csv"
    path.write_text("Delta Table Name,Column Name,Field type,Transformation Pattern\nt,id,INT,\"1,4\"\nt,name,,\n")
    loaded = load_column_rules(spark, str(path))
    assert [(r.column_name, r.field_type, r.transformation_pattern) for r in loaded] == [
        ("id", "INT", "1,4"), ("name", "STRING", None)]
    assert rules_frame(spark, loaded, ColumnRule).count() == 2


def test_name_patterns():
    import re
    rx = files.name_regex("site_<yyyy><mm><dd>_<hhmmss>.csv")
    for name, fits in {"site_20251201_120001.csv": True, "site_20251201.csv": True, "site_20251201_120001xcsv": False,
                       "xsite_20251201.csv": False, "site_2025120.csv": False}.items():
        assert bool(re.match(rx, name)) is fits, name
    assert re.match(files.name_regex("site_{yyyy}{mm}{dd}_{HHmmss}.csv"), "site_20251201_120001.csv")
    assert not files.has_date("site.csv") and files.has_date("a_{YYYY}.csv")


def test_name_dates(spark):
    rows = [("users_20251225_143059.csv", (2025, 12, 25, 14, 30, 59), None), ("a_202502.csv", (2025, 2, None, None, None, None), None),
            ("x/a_20250230.csv", (2025, 2, 30, None, None, None), files.INVALID_NAME_DATE),
            ("plain.csv", (None,) * 6, files.MISSING_NAME_DATE), ("w_2025_12_01.csv", (2025, 12, 1, None, None, None), None),
            ("m_202512_120001.csv", (2025, 12, None, 12, 0, 1), None), ("c20251225143059x.csv", (2025, 12, 25, 14, 30, 59), None)]
    df = spark.createDataFrame([(r[0],) for r in rows], "n string")
    got = df.select("n", files.name_parts(F.col("n")).alias("p"), files.name_error(F.col("n")).alias("e"),
                    files.stem(F.col("n")).alias("s")).collect()
    assert [(r["n"], tuple(r["p"]), r["e"]) for r in got] == rows
    assert got[2]["s"] == "a_20250230"


def test_bool_column(spark):
    df = spark.createDataFrame([("Yes",), ("non",), ("?",), (None,)], "x string")
    assert values(df.select(settings.bool_column(F.col("x"), None))) == [True, False, None, None]
