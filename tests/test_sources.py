import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidegate.rules import ColumnRule, TableRule
from tidegate.sources.archive import archive_lines, archives, parse_lines
from tidegate.sources.delimited import CORRUPT, LINEAGE, file_heads, read_delimited, read_files, read_fixed_width
from tidegate.sources.discovery import dated_names, empty_files, list_files, match_files, selected_files, unmatched_tables
from tidegate.sources.lines import with_line_id

NAMES = ["id", "name", "date"]
TEXT = "id,name,date\n1,Alice,2025-01-01\n2,Bob,2025-01-02\n"


def read(spark, path, names=NAMES, **rule):
    return read_delimited(spark, path, TableRule("t", **rule), names, lineage=False)


def test_header_modes(spark, put):
    path = put("a.csv", TEXT)
    assert values(read(spark, path, header="FIRST LINE"), "id", "name") == [("1", "Alice"), ("2", "Bob")]
    renamed = read(spark, path, ["a", "b", "c"], header="HEADER USE")
    assert values(renamed, "a", "c") == [("1", "2025-01-01"), ("2", "2025-01-02")]
    assert values(read(spark, path, header="NO_HEADER"), "id") == ["id", "1", "2"]
    assert read(spark, path, header="FIRST_LINE").columns == [*NAMES, CORRUPT]
    with pytest.raises(ValueError):
        read(spark, path, ["a", "b"], header="FIRST_LINE_ONLY")


def test_column_order_is_kept(spark, put):
    df = read(spark, put("a.csv", "z_column,a_column,m_column\n1,2,3\n"), [], header="FIRST LINE")
    assert df.columns[:3] == ["z_column", "a_column", "m_column"] and values(df, "a_column") == ["2"]


@pytest.mark.parametrize("sep,given", [(";", ";"), ("\t", "tab"), ("\t", "\\t"), ("|", "pipe"), ("'", "'")])
def test_separators(spark, put, sep, given):
    path = put("a.csv", TEXT.replace(",", sep))
    assert values(read(spark, path, header="FIRST LINE", delimiter=given), "name") == ["Alice", "Bob"]


def test_quotes(spark, put):
    path = put("a.csv", 'id,name,date\n1,"say \\"hi\\", you",d\n2,"two\nlines",d\n')
    got = read(spark, path, header="FIRST LINE", input_format="csv_quote_ml")
    assert values(got, "name") == ['say "hi", you', "two\nlines"]
    one = put("b.csv", 'id,name,date\n1,"a, b",d\n')
    assert values(read(spark, one, header="FIRST LINE", input_format="csv_quote"), "name") == ["a, b"]


def test_charsets(spark, put):
    latin = put("l.csv", "id,name,date\n1,Élysée,d\n", "latin-1")
    assert values(read(spark, latin, header="FIRST LINE", charset="Latin1"), "name") == ["Élysée"]
    ansi = put("w.csv", "id,name,date\n1,œuvre – 5€,d\n", "cp1252")
    assert values(read(spark, ansi, header="FIRST LINE", charset="ANSI"), "name") == ["œuvre – 5€"]
    utf8 = put("u.csv", "id,name,date\n1,日本 🎉,d\n")
    assert values(read(spark, utf8, header="FIRST LINE"), "name") == ["日本 🎉"]


@pytest.mark.parametrize("charset,codec,text", [("Latin1", "latin-1", "Élysée\nà"), ("ANSI", "cp1252", "œuvre –\n5€"), ("ISO-8859-15", "iso-8859-15", "œuvre\n5€"),
                                                ("US-ASCII", "latin-1", "\ufffdlys\ufffde\nx"), ("UTF-8", "latin-1", "\ufffdlys\ufffde\nx")])
def test_charsets_of_lines(spark, put, charset, codec, text):
    """The formats that are cut out of lines: quoted text of several lines, fixed width, and the heads of files."""
    stored = text if "\ufffd" not in text else "Élysée\nx"
    quoted = put("q.csv", f'id;"{stored}"\n1;"{stored}"\n', codec)
    got = read(spark, quoted, ["id", "name"], input_format="csv_quote_ml", charset=charset, delimiter=";")
    assert values(got, "id", "name") == [("id", text), ("1", text)]
    fixed = put("f.txt", "1" + stored.partition("\n")[0] + "|\n", codec)
    width = len(text.partition("\n")[0])
    rules = [ColumnRule("id", column_size=1, field_order=1), ColumnRule("name", column_size=width, field_order=2), ColumnRule("end", column_size=1, field_order=3)]
    rows = read_fixed_width(spark, fixed, TableRule("t", input_format="fixed", charset=charset), rules, lineage=False)
    assert values(rows, "id", "name", "end") == [("1", text.partition("\n")[0], "|")]
    heads = file_heads(spark, put("h.csv", "1;" + stored.partition("\n")[0] + "\n", codec), TableRule("t", delimiter=";", charset=charset))
    assert values(heads, "head") == ["1;" + text.partition("\n")[0]]


def test_corrupt_lines_survive_pruning(spark, put):
    path = put("a.csv", "1,a,x\n2\n3,c,z\n4,d,e,f\n")
    df = read(spark, path)
    assert values(df.select("name", CORRUPT)) == [("a", None), (None, "2"), ("c", None), ("d", "4,d,e,f")]
    assert values(df.select("date", CORRUPT).filter(F.col(CORRUPT).isNull()), "date") == ["x", "z"]


def test_fixed_width(spark, put):
    rules = [ColumnRule("b", column_size=3, field_order=2), ColumnRule("a", column_size=2, field_order=1), ColumnRule("c", field_order=3)]
    df = read_fixed_width(spark, put("a.txt", "12abcZrest\n7\n"), TableRule("t", input_format="fixed"), rules, lineage=False)
    assert df.columns == ["a", "b", "c", CORRUPT]
    assert values(df, "a", "b", "c") == [("12", "abc", "Z"), ("7", "", "")]


def test_unknown_format(spark, put):
    with pytest.raises(ValueError, match="Unsupported format"):
        read_files(spark, put.inbox, TableRule("t", input_format="excel"), [])


@pytest.mark.parametrize("header", ["FIRST LINE", None])
def test_line_numbers_over_many_splits(spark, put, header):
    for name, count in (("a_20250101.csv", 5000), ("a_20250102.csv", 3), ("a_20250103.csv", 2500)):
        lines = [f"{i},{name}" for i in range(1, count + 1)]
        put(name, "\n".join((["n,f"] if header else []) + lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        raw = read_delimited(spark, put.inbox, TableRule("t", header=header), ["n", "f"], "a_*.csv")
        assert raw.rdd.getNumPartitions() > 8 and set(LINEAGE) < set(raw.columns)
        numbered = with_line_id(raw)
        assert numbered.count() == 7503
        assert numbered.filter("line_id <> cast(n AS long)").count() == 0
        running = with_line_id(raw, per_file=False)
        assert sorted(values(running, "line_id")) == list(range(1, 7504))
        assert running.filter("f = 'a_20250103.csv' AND line_id <> cast(n AS long) + 5003").count() == 0
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


RULES = [TableRule("site", filename_pattern="site_<yyyy><mm><dd>_<hhmmss>.csv"),
         TableRule("all", filename_pattern="site_{yyyy}{mm}{dd}.csv", merge_files=True),
         TableRule("gone", filename_pattern="gone_<yyyy>.csv")]


def test_discovery(spark, put):
    for name in ("site_20251201_120001.csv", "site_20251202.csv", "site_20251203.csv", "site_20251301.csv", "other.csv"):
        put(name, "" if name == "site_20251203.csv" else "x\n")
    listing = list_files(spark, put.inbox)
    assert listing.count() == 4 and empty_files(spark, put.inbox) == 1 and empty_files(spark, put.inbox, "other*") == 0
    matched = match_files(listing, RULES)
    assert matched.filter("table_name = 'site'").count() == 3 and matched.filter("table_name = 'all'").count() == 2
    chosen = selected_files(matched, RULES)
    assert values(chosen.filter("table_name = 'site'"), "name") == ["site_20251201_120001.csv"]
    assert chosen.filter("table_name = 'all'").count() == 2
    assert values(unmatched_tables(matched, RULES)) == [("gone", "No file matched gone_<yyyy>.csv")]
    bad = dated_names(listing).filter("error_message IS NOT NULL")
    assert {r["name"]: r["error_message"] for r in bad.collect()} == {
        "site_20251301.csv": "INVALID DATE in filename", "other.csv": "Missing/invalid date pattern in filename"}
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_archives(spark, put, monkeypatch):
    import tidegate.sources.archive as archive
    box = io.BytesIO()
    with zipfile.ZipFile(box, "w") as out:
        out.writestr("a.csv", "id,name\n1,Élysée\n2,b\n")
        out.writestr("sub/c.csv", "id,name\r\n3\r\n4,d")
        out.writestr("empty/", "")
    with open(f"{put.inbox}/x.zip", "wb") as f:
        f.write(box.getvalue())
    lines = archive_lines(archives(spark, put.inbox))
    assert lines.count() == 6
    rows = parse_lines(lines, ["id", "name"])
    got = sorted((r["_file"], r["line_id"], r["id"], r["name"], r[CORRUPT]) for r in rows.collect())
    assert got == [("a.csv", 1, "1", "Élysée", None), ("a.csv", 2, "2", "b", None),
                   ("sub/c.csv", 1, "3", None, "3"), ("sub/c.csv", 2, "4", "d", None)]
    assert archive.LINES_PER_BATCH > 1


@pytest.mark.parametrize("rows", [10_000, 100_000])
def test_large_files_are_counted_quickly(spark, put, rows):
    import time
    path = put("big.csv", "id,name,value,date\n" + "\n".join(f"{i},name{i},{i * 1.5},2025-01-01" for i in range(rows)) + "\n")
    began = time.time()
    assert read(spark, path, ["id", "name", "value", "date"], header="FIRST LINE").count() == rows
    assert time.time() - began < 30


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_heads_are_found_without_sorting_lines(spark, put):
    for name in ("a.csv", "b.csv"):
        put(name, "\n  \n" + TEXT)
    heads = file_heads(spark, put.inbox, TableRule("t"))
    assert values(heads, "head") == ["id,name,date"] * 2
    assert "Sort" not in plan_of(heads)
