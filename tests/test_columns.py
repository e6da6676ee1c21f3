import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import values
from tidegate.functions import checks, numbers
from tidegate.functions.dates import date_error, parse_temporal, parse_timestamp, pattern_shape, patterns_for, temporal_default
from tidegate.functions.text import blank_to_null, capitalize, concat_text, transform
from tidegate.functions.typing import safe_cast, spark_type
from tidegate.operators.cleanse import cleanse, error_lines
from tidegate.rules import ColumnRule


@pytest.mark.parametrize("kind,pattern,replacement,given,expected", [
    ("uppercase", None, None, ["alice", "Charlie", None], ["ALICE", "CHARLIE", None]),
    ("lowercase", None, None, ["ALICE", "DaViD"], ["alice", "david"]),
    ("capitalize", None, None, ["alice", "BOB", "", "two Words"], ["Alice", "Bob", "", "Two words"]),
    ("trim", None, None, ["  a ", "b"], ["a", "b"]),
    ("ltrim", None, None, ["  a "], ["a "]),
    ("rtrim", None, None, ["  a "], ["  a"]),
    ("regex", "-", "_", ["hello-world-x"], ["hello_world_x"]),
    ("regex_replace", "[0-9]", None, ["a1b2"], ["ab"]),
    ("regex_extract", r"user(\d+)", None, ["user123", "none"], ["123", ""]),
    ("substring", "1,4", None, ["ABCDEFGH"], ["ABCD"]),
    ("left", "3", None, ["ABCDEFGH"], ["ABC"]),
    ("right", "3", None, ["ABCDEFGH", "x"], ["FGH", "x"]),
    ("lpad", "5,0", None, ["42", "123456"], ["00042", "12345"]),
    ("rpad", "5,X", None, ["BC"], ["BCXXX"]),
    ("rpad", "3,,", None, ["a"], ["a,,"]),
    ("email", None, None, ["kept"], ["kept"]),
])
def test_transforms(spark, kind, pattern, replacement, given, expected):
    df = spark.createDataFrame([(v,) for v in given], "v string")
    assert values(df.select(transform(F.col("v"), kind, pattern, replacement))) == expected


def test_bad_transform_arguments():
    with pytest.raises(ValueError):
        transform(F.lit("x"), "substring", "1")


def test_several_at_once(spark):
    raw = spark.createDataFrame([("  Alice ", "BOB")], "name1 string, name2 string")
    out = cleanse(raw, [ColumnRule("name1", transformation_type="trim"), ColumnRule("name2", transformation_type="lowercase")])
    assert values(out, "name1", "name2") == [("Alice", "bob")]


def test_concat_blank_null(spark):
    df = spark.createDataFrame([("John", "Doe"), (" ", None)], "a string, b string")
    assert values(df.select(concat_text(F.col("a"), F.col("b")))) == ["John Doe", None]
    assert values(df.select(blank_to_null(F.col("a")))) == ["John", None]
    assert values(df.select(capitalize(F.col("b")))) == ["Doe", None]


def test_safe_casts(spark):
    df = spark.createDataFrame([("1",), ("1,5",), ("6.55",), (" 7 ",), ("x",), ("",), (None,)], "v string")
    assert values(df.select(safe_cast(F.col("v"), spark_type("INT")))) == [1, None, None, 7, None, None, None]
    assert values(df.select(safe_cast(F.col("v"), spark_type("DOUBLE")))) == [1.0, 1.5, 6.55, 7.0, None, None, None]


FORMS = [("2025-01-02", dt.date(2025, 1, 2)), ("02/01/2025", dt.date(2025, 1, 2)), ("02/01/2025 10:11:12", dt.date(2025, 1, 2)),
         ("2025-01-02 10:11:12", dt.date(2025, 1, 2)), ("20250102", dt.date(2025, 1, 2)), ("20250102101112", dt.date(2025, 1, 2)),
         ("2025-01-02T10:11:12", dt.date(2025, 1, 2)), ("2025-02-30", None), ("1/2/2025", None), ("", None), (None, None),
         ("invalid_date", None), ("99/99/9999", None)]


def test_date_forms(spark):
    df = spark.createDataFrame([(v,) for v, _ in FORMS], "v string")
    assert values(df.select(parse_temporal(F.col("v"), T.DateType()))) == [d for _, d in FORMS]
    # The shape test only saves work: without it the same patterns give the same dates.
    slow = F.coalesce(*[F.try_to_timestamp(F.col("v"), F.lit(p)) for p in patterns_for(None)])
    assert values(df.select(slow.cast("date"))) == [d for _, d in FORMS]


ODD = ["1", "+1", "-7 ", "\t8\n", "1.0", ".5", "5.", "1e3", "1E-2", "inf", "-Infinity", "NaN", "0x1p3", "1d", "2f", "1,5", "", " ",
       "--1", "n/a", "abc", "1a", "99999999999", "９", "1 2", "+", "e5", "true", "T", "yes", "No", "0", "oui", "\x7f3"]


@pytest.mark.parametrize("token", ["INT", "LONG", "FLOAT", "DOUBLE", "DECIMAL", "BOOLEAN"])
def test_guards_never_stop_a_good_value(spark, token):
    kind = spark_type(token, 20, 4)
    df = spark.createDataFrame([(v,) for v in ODD], "v string")
    plain = F.translate(F.col("v"), ",", ".").try_cast(kind) if token != "BOOLEAN" else F.col("v").try_cast(kind)
    assert list(map(str, values(df.select(safe_cast(F.col("v"), kind))))) == list(map(str, values(df.select(plain))))


def test_date_guards_never_stop_a_good_value(spark):
    dates = spark.sql("SELECT explode(sequence(timestamp'2023-12-25 23:59:59', timestamp'2024-03-05 00:00:00', interval 7 hours)) AS t")
    for pattern in patterns_for(None):
        text = dates.select(F.date_format("t", pattern).alias("v"))
        odd = text.filter(~parse_timestamp(F.col("v"), [pattern]).eqNullSafe(F.try_to_timestamp("v", F.lit(pattern))))
        assert odd.count() == 0 and text.filter(parse_timestamp(F.col("v"), [pattern]).isNull()).count() == 0


def test_configured_pattern_first(spark):
    df = spark.createDataFrame([("01/02/2025",), ("3 Jan 2025",)], "v string")
    assert values(df.select(parse_temporal(F.col("v"), T.DateType(), "MM/dd/yyyy")))[0] == dt.date(2025, 1, 2)
    assert values(df.select(parse_temporal(F.col("v"), T.DateType(), "d MMM yyyy")))[1] == dt.date(2025, 1, 3)
    assert pattern_shape("d MMM yyyy") is None and pattern_shape("yyyy''MM") is None
    stamp = df.select(parse_timestamp(F.lit("20250102101112"), patterns_for(None))).first()[0]
    assert (stamp.hour, stamp.second) == (10, 12)


def test_date_errors_and_default(spark):
    df = spark.createDataFrame([("2025-01-01",), ("01/12/2025",), ("invalid_date",), ("",), (None,)], "d string")
    rules = [ColumnRule("d", field_type="DATE", default_invalid="2000-01-01")]
    out = cleanse(df, rules).withColumn("line_id", F.monotonically_increasing_id())
    fallback = dt.date(2000, 1, 1)
    assert values(out, "d") == [dt.date(2025, 1, 1), dt.date(2025, 12, 1), fallback, fallback, fallback]
    errors = error_lines(out, rules, "t").select("error_type", "raw_value", "default_applied").collect()
    assert sorted(map(tuple, errors)) == [("EMPTY_DATE", "", "2000-01-01"), ("INVALID_DATE", "invalid_date", "2000-01-01")]
    parsed = parse_temporal(F.col("d"), T.DateType())
    assert values(df.select(date_error(F.col("d"), parsed))) == [None, None, "INVALID_DATE", "EMPTY_DATE", None]
    for blank in ("", "nan", None, "not a date"):
        assert spark.range(1).select(temporal_default(blank, T.DateType())).first()[0] is None


def test_checks(spark):
    mails = {"test@example.com": True, "user.name@domain.co.uk": True, "invalid_email": False, "@example.com": False, "a@b": False}
    df = spark.createDataFrame([(m,) for m in mails], "m string")
    assert values(df.select(checks.is_email(F.col("m")))) == list(mails.values())
    places = {"123 Main Street": True, "Avenue des Champs-Elysées": True, "": False, "   ": False, "#": False}
    df = spark.createDataFrame([(p,) for p in places], "p string")
    assert values(df.select(checks.is_address(F.col("p")))) == list(places.values())


def test_check_errors_in_cleanse(spark):
    df = spark.createDataFrame([("a@b.org", "A"), ("bad", "Z"), (None, None), ("", "")], "mail string, kind string")
    rules = [ColumnRule("mail", transformation_type="email"),
             ColumnRule("kind", transformation_type="enumeration", enumeration=("A", "B"), default_invalid="B")]
    out = cleanse(df, rules)
    assert values(out, "mail", "kind") == [("a@b.org", "A"), (None, "B"), (None, "B"), (None, "B")]
    kinds = [[e["error_type"] for e in r["_errors"] or []] for r in out.collect()]
    assert kinds == [[], ["INVALID_EMAIL", "INVALID_ENUM"], [], []]


def test_formulas(spark):
    df = spark.createDataFrame([(10.0, 5), (20.0, 10), (15.0, 0)], "a double, b int")
    assert values(df.select(numbers.revenue(F.col("a"), F.col("b")))) == [50.0, 200.0, 0.0]
    assert values(df.select(numbers.percentage(F.col("b"), F.col("a")))) == [50.0, 50.0, 0.0]
    assert values(df.select(numbers.growth_rate(F.col("a"), F.col("b")))) == [100.0, 100.0, None]


def test_cleansing_parses_each_date_once_per_pattern(spark):
    df = spark.createDataFrame([("x", "1")], "d string, n string")
    plan = cleanse(df, [ColumnRule("d", field_type="DATE", default_invalid="2000-01-01"), ColumnRule("n", field_type="INT")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("gettimestamp(") == len(patterns_for(None))
    assert "Exchange" not in text and "Python" not in text
