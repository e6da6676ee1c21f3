from pyspark.sql import functions as F

from tests.conftest import values
from tidegate.operators.aggregates import dealt_by_range, merged_quantiles, quantile_sketches, row_numbers
from tidegate.operators.cleanse import cleanse
from tidegate.operators.members import flag_members, value_list
from tidegate.rules import ColumnRule

DATA = [(1, "a"), (2, " b "), (3, "z"), (4, None), (5, ""), (6, None), (7, "a")]


def test_flags_keep_every_row(spark, tmp_path):
    df = spark.createDataFrame(DATA, "id int, v string")
    (tmp_path / "list.csv").write_text("name,more\na,1\nb,2\na,3\n,4\n")
    listed = value_list(spark, f"file://{tmp_path}/list.csv")
    assert sorted(values(listed)) == ["a", "b"]
    want = [(1, True), (2, True), (3, False), (4, None), (5, False), (6, None), (7, True)]
    for limit in (1 << 20, 0):
        got = flag_members(df, "v", listed, "hit", limit)
        assert got.columns == ["id", "v", "hit"] and sorted(values(got, "id", "hit")) == want
    plan = flag_members(df, "v", listed, "hit")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert sorted(values(flag_members(df, "v", listed.limit(0), "hit"), "hit"), key=str) == [False] * 5 + [None] * 2


def test_a_rule_may_name_a_table_of_values(spark, tmp_path):
    spark.createDataFrame([("A",), ("b",)], "code string").write.parquet(str(tmp_path / "codes"))
    rule = ColumnRule.of({"Column Name": "v", "Enumeration Table": str(tmp_path / "codes"), "Default Value when Invalid": "other", "Transformation Type": "lowercase"})
    got = cleanse(spark.createDataFrame(DATA, "id int, v string"), [rule], trim=True)
    rows = {r["id"]: (r["v"], r["_errors"] and r["_errors"][0]["error_type"]) for r in got.collect()}
    assert rows == {1: ("other", "INVALID_ENUM"), 2: ("b", None), 3: ("other", "INVALID_ENUM"), 4: ("other", None), 5: ("other", None), 6: ("other", None), 7: ("other", "INVALID_ENUM")}


def test_numbers_of_one_group_come_from_many_tasks(spark):
    df = spark.range(10_000).selectExpr("id", "'x' AS g", "id % 7 AS v").repartition(4)
    order = [F.col("v").desc(), F.col("id")]
    got = row_numbers(df, ["g"], order, name="n")
    rows = sorted(got.collect(), key=lambda r: r["n"])
    assert [(r["v"], r["id"]) for r in rows] == sorted(((i % 7, i) for i in range(10_000)), key=lambda r: (-r[0], r[1])) and [r["n"] for r in rows] == list(range(1, 10_001))
    # Small partitions would be put together.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r["count"] for r in dealt_by_range(df, ["g"], order).groupBy(F.shiftright("_at", 33)).count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]


def test_numbers_with_nulls_ties_and_repeated_rows(spark):
    data = [(None, 1)] * 5 + [("a", None)] * 3 + [("a", 2)] * 400 + [("b", 1)]
    got = row_numbers(spark.createDataFrame(data, "g string, v int").repartition(6), ["g"], [F.col("v").asc_nulls_last()], name="n").collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append((r["n"], r["v"]))
    assert {g: [n for n, _ in sorted(v)] for g, v in by.items()} == {None: [1, 2, 3, 4, 5], "a": list(range(1, 404)), "b": [1]}
    assert [v for _, v in sorted(by["a"], key=lambda x: x[0])] == [2] * 400 + [None] * 3
    assert row_numbers(spark.createDataFrame([], "g string, v int"), ["g"], [F.col("v")]).count() == 0


def test_sketches_merge(spark):
    df = spark.range(20_000).selectExpr("id % 10 AS day", "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS g", "CAST(id AS DOUBLE) AS v")
    daily = quantile_sketches(df, "v", ["g", "day"])
    assert daily.count() == 10
    for r in merged_quantiles(daily, ["g"], [0.1, 0.5, 0.99]).collect():
        assert r["value_count"] == 10_000 and all(abs(r[q] - share * 20_000) < 80 for q, share in (("q10", 0.1), ("q50", 0.5), ("q99", 0.99)))
