import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegate.operators.aggregates import numeric_profile, row_numbers


def test_profile(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (None,), (30.0,), (50.0,), (40.0,)], "v double")
    row = numeric_profile(df, "v").first()
    assert (row["row_count"], row["value_count"], row["total"], row["mean"], row["spread"]) == (6, 5, 150.0, 30.0, 40.0)
    assert row["deviation"] == pytest.approx(15.811, abs=1e-3) and row["median"] == 30.0


def test_groups(spark):
    df = spark.createDataFrame([("A", 10), ("A", 20), ("B", 30), ("B", 40), ("C", 50)], "g string, v int")
    got = {r["g"]: (r["total"], r["mean"]) for r in numeric_profile(df, "v", ["g"]).collect()}
    assert got == {"A": (30, 15.0), "B": (70, 35.0), "C": (50, 50.0)}


def test_median_rank_error(spark):
    df = spark.range(100_001).select((F.col("id") * 7919 % 100_001).cast("double").alias("v"))
    median = numeric_profile(df, "v", accuracy=100).first()["median"]
    assert abs(median - 50_000) <= 0.01 * 100_001


def test_row_numbers_equal_a_window(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise((F.col("id") % 50).cast("string")).alias("g"),
        (F.col("id") * 31 % 997).alias("t"), "id")
    got = row_numbers(df, ["g"], [F.col("t"), F.col("id")], F.floor(F.col("t") / 100))
    plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")))
    joined = got.join(plain.select("id", "rn"), "id")
    assert joined.count() == 20_000 and joined.filter("row_number <> rn").count() == 0
