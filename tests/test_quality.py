import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidegate.operators import actions, quality, shape
from tidegate.rules import ColumnRule


def found(df):
    return sorted((r["column_name"], r["error_message"], r["error_count"]) for r in df.collect())


def test_duplicate_and_null_keys(spark):
    df = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 1, "c"), (4, None, "d")], "line_id long, id int, v string")
    assert found(quality.check_data_quality(df, "t", ["id"], "f.csv")) == [("id", "DUPLICATE_KEY", 2), ("id", "NULL_KEY", 1)]
    df = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")], "line_id long, id int, v string")
    assert found(quality.check_data_quality(df, "t", ["id"])) == [("id", "DUPLICATE_KEY", 2)]


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, None, None), (2, None, None)]])
def test_empty_file_is_a_single_error(spark, rows):
    df = spark.createDataFrame(rows, "line_id long, id int, v string")
    assert found(quality.check_data_quality(df, "t", ["id"], "f", ["v"])) == [("ALL_COLUMNS", "FILE_EMPTY_OR_ALL_NULL", 1)]


def test_null_lines_skip_hollow_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "c", None)], "line_id long, a string, b string")
    errors = quality.check_data_quality(df, "t", [], "f", ["a", "b"])
    assert found(errors) == [("a", "NULL_VALUE", 1), ("b", "COLUMN ALL NULL", 3)]
    assert errors.filter("error_message = 'NULL_VALUE'").first()["line_id"] == 2


def test_corrupt_tolerance(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, _corrupt_record string")
    row = quality.corrupt_verdict(df, "_corrupt_record", "10%").first()
    assert (row["total_rows"], row["corrupt_rows"], row["is_valid"]) == (3, 1, False)
    clean = spark.range(100).withColumn("_corrupt_record", F.lit(None).cast("string"))
    assert quality.corrupt_verdict(clean, "_corrupt_record", "0").first()["is_valid"] is True


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, "a string, b string, c string")


def ict(*names, **more):
    return [ColumnRule(n, is_nullable=False, **more) for n in names]


def test_ict_driven_rows(spark):
    df = rows_of(spark, ("1", "1", "1"), (None, "1", "1"), (None, None, "1"))
    assert actions.apply_actions(df, ict("a", "b", "c")).count() == 2
    assert actions.apply_actions(df, ict("a", "b", "c"), min_allowed=0).count() == 1


def test_ict_limit_counts_only_columns_with_nulls(spark):
    names = [f"c{i}" for i in range(30)]
    schema = ", ".join(f"{n} string" for n in names)
    # Thirty flagged columns allow three nulls, nineteen allow one.
    holes = [tuple(None if i == j else "x" for i in range(30)) for j in range(30)]
    three = tuple(None if i < 3 else "x" for i in range(30))
    kept = actions.apply_actions(spark.createDataFrame(holes + [three], schema), ict(*names))
    assert kept.count() == 31
    two = tuple(None if i < 2 else "x" for i in range(30))
    kept = actions.apply_actions(spark.createDataFrame(holes[:19] + [two], schema), ict(*names))
    assert kept.count() == 19


def test_reject_hides_rows_from_later_counts(spark):
    df = rows_of(spark, (None, None, "1"), ("1", None, "1"), ("1", "1", "1"))
    rules = [ColumnRule("a", is_nullable=False, error_action="REJECT"),
             ColumnRule("b", is_nullable=False, error_action="LOG_ONLY")]
    counts = df.agg(F.count(F.lit(1)).alias("n"), *actions.action_counts(rules))
    summary = {r["column_name"]: (r["error_type"], r["error_count"]) for r in actions.action_summary(counts, rules, "n").collect()}
    assert summary == {"a": ("REJECT", 1), "b": ("LOG_ONLY", 1)}
    assert actions.apply_actions(df, rules).count() == 2


def test_abort_empties_the_file_concerned_only(spark):
    df = spark.createDataFrame([("f1", None), ("f1", "x"), ("f2", "x"), ("f2", "y")], "f string, a string")
    kept = actions.apply_actions(df, ict("a", tolerance="10%"), by="f")
    assert {r["f"] for r in kept.collect()} == {"f2"} and kept.count() == 2
    assert actions.apply_actions(df, ict("a", tolerance="60%"), by="f").count() == 4


def test_kept_and_refused_make_the_total(spark):
    df = spark.range(1000).select(*[F.when(F.col("id") % p > 0, F.col("id")).alias(n) for n, p in (("a", 3), ("b", 5), ("c", 7))])
    kept = actions.apply_actions(df, ict("a", "b", "c"))
    refused = df.filter(actions.invalid_columns(ict("a", "b", "c")) > 1)
    assert kept.count() + refused.count() == 1000


def test_error_summary(spark):
    errors = spark.createDataFrame([("Invalid x", 2), ("NULL_VALUE", 5), ("Invalid x", 1), ("Null value detected", 1)],
                                   "error_message string, error_count long")
    assert [tuple(r) for r in quality.error_summary(errors).select("error_message", "total_count", "family").collect()] == [
        ("NULL_VALUE", 5, "null"), ("Invalid x", 3, "format"), ("Null value detected", 1, "null")]
    assert tuple(quality.cleaned_rows(10, errors).first()) == (10, 3, 7)
    assert tuple(quality.cleaned_rows(10, errors.limit(0)).first()) == (10, 0, 10)


def test_expectations_keep_rows(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    got = {r["expectation"]: (r["total_rows"], r["violations"]) for r in quality.expectations(df, {"known": "x IS NOT NULL", "big": "x > 2"}).collect()}
    assert got == {"known": (3, 1), "big": (3, 2)}


def test_columns(spark):
    df = spark.createDataFrame([(" a ", 1, "b")], "name string, n int, `x.y` string")
    assert values(shape.trim_all(df)) == [("a", 1, "b")]
    assert shape.missing_columns(df, ["NAME", "z"]) == ["z"]
    assert shape.fill_columns(df, ["n", "z"]).dtypes == [("name", "string"), ("n", "string"), ("x.y", "string"), ("z", "string")]
    doubled = df.toDF("a", "b", "A")
    assert values(shape.dedup_columns(doubled)) == [(" a ", 1)]
    assert shape.move_first(df, ["n"]).columns == ["n", "name", "x.y"]
    with pytest.raises(ValueError):
        shape.rename_by_position(df, ["a"])
    errors = shape.missing_column_errors(df, ["name", "z"], "t", "f.csv")
    assert values(errors) == [("t", "f.csv", "z", "MISSING_COLUMN")]
