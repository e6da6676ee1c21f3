import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidegate.operators import modes

STATE = "id int, name string, at int"


def frame(spark, rows, schema=STATE):
    return spark.createDataFrame(rows, schema)


def state_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name,action,known", [
    ("FULL_SNAPSHOT", "snapshot", True), ("overwrite", "snapshot", True), (" delta_from_flow ", "append", True),
    ("DELTA_FROM_LOT", "append", True), ("DELTA_FROM_HISTORIZED", "append", True), ("APPEND", "append", True),
    ("MERGE", "merge", True), ("DELTA_FROM_NON_HISTORIZED", "merge", True), ("FULL_KEY_REPLACE", "key_replace", True),
    ("else", "append", False), (None, "append", False)])
def test_mode_names(name, action, known):
    assert modes.mode_action(name) == (action, known)


@pytest.mark.parametrize("size", [None, 10])
def test_merge(spark, size):
    target = frame(spark, [(1, "old", 5), (2, "keep", 9), (3, "tie", 4), (4, "blank", None), (None, "loose", 1)])
    batch = frame(spark, [(1, "new", 6), (2, "late", 8), (3, "same", 4), (4, "never", 9), (5, "add", 1), (None, "free", 1),
                          (None, "free", 1), (1, "older", 3)])
    merged = modes.merge_newest(target, batch, ["id"], "at", batch_bytes=size)
    assert state_of(merged) == sorted([
        (1, "new", 6), (2, "keep", 9), (3, "tie", 4), (4, "blank", None), (5, "add", 1), (None, "loose", 1),
        (None, "free", 1), (None, "free", 1)], key=repr)


@pytest.mark.parametrize("size", [None, 10])
def test_merge_columns(spark, size):
    target = frame(spark, [(1, 1, "kept", 1)], "id int, at int, own string, v long")
    batch = frame(spark, [(1, 2, 7, "x"), (2, 2, 8, "y")], "id int, at int, v int, other string")
    merged = modes.merge_newest(target, batch, ["id"], "at", batch_bytes=size)
    assert merged.dtypes == target.dtypes
    assert state_of(merged) == [(1, 2, "kept", 7), (2, 2, None, 8)]


def test_merge_ties_take_the_later_line(spark):
    batch = frame(spark, [(1, "a", 5, 1), (1, "b", 5, 2), (1, "c", 4, 3)], STATE + ", _line int")
    assert state_of(modes.merge_newest(None, batch, ["id"], "at", ["_line"])) == [(1, "b", 5)]


def test_merge_text_dates(spark):
    target = frame(spark, [(1, "01/02/2025"), (2, "2025-03-01 10:00:00")], "id int, at string")
    batch = frame(spark, [(1, "15/01/2025"), (2, "2025-03-01 11:00:00")], "id int, at string")
    assert state_of(modes.merge_newest(target, batch, ["id"], "at")) == [(1, "01/02/2025"), (2, "2025-03-01 11:00:00")]


def model(state, batch):
    """Plain-Python model: last writer wins only when strictly newer."""
    best = {}
    for key, value, at in batch:
        if key not in best or at > best[key][1]:
            best[key] = (value, at)
    out = dict(state)
    for key, (value, at) in best.items():
        if key not in out or at > out[key][1]:
            out[key] = (value, at)
    return out


def test_merge_against_model_and_idempotence(spark):
    rnd = random.Random(7)
    times = rnd.sample(range(10_000), 900)
    rows = [(rnd.choice([1] * 200 + list(range(400))), f"v{t}", t) for t in times]
    start, batch = rows[:300], rows[300:]
    state = modes.merge_newest(None, frame(spark, start), ["id"], "at")
    expected = model(model({}, start), batch)
    want = sorted(((k, v, t) for k, (v, t) in expected.items()), key=repr)
    for size in (None, 10):
        merged = modes.merge_newest(state, frame(spark, batch), ["id"], "at", batch_bytes=size)
        assert state_of(merged) == want
        again = modes.merge_newest(merged, frame(spark, batch), ["id"], "at", batch_bytes=size)
        assert state_of(again) == want
    backwards = modes.merge_newest(state, frame(spark, batch[::-1]), ["id"], "at")
    assert state_of(backwards) == want


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    for name, rows in (("t", 1000), ("b", 10)):
        spark.range(rows).select(F.col("id"), F.lit("x").alias("name"), F.col("id").alias("at")).write.parquet(str(tmp_path / name))
    target, batch = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "b"))
    merged = modes.merge_newest(target, batch, ["id"], "at", batch_bytes=1000)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_key_replace(spark):
    target = frame(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "d", 4)])
    batch = frame(spark, [(1, "n", 9), (3, "m", 9), (None, "o", 9)])
    got = modes.apply_mode("FULL_KEY_REPLACE", target, batch, ["id"])
    assert state_of(got) == sorted([(2, "c", 3), (None, "d", 4), (1, "n", 9), (3, "m", 9), (None, "o", 9)], key=repr)
    # A row goes only when its whole key occurs in the batch.
    got = modes.key_replace(target, frame(spark, [(1, "a", 9), (2, "zz", 9)]), ["id", "name"])
    assert state_of(got) == sorted([(1, "b", 2), (2, "c", 3), (None, "d", 4), (1, "a", 9), (2, "zz", 9)], key=repr)


def test_keys_are_required(spark):
    df = frame(spark, [(1, "a", 1)])
    for mode in ("MERGE", "FULL_KEY_REPLACE"):
        with pytest.raises(ValueError):
            modes.apply_mode(mode, df, df)


def test_snapshot_and_append(spark):
    target = frame(spark, [(1, "a", 1)])
    batch = frame(spark, [(2, "b", 2)]).withColumn(modes.PROCESS_DATE, F.lit(dt.datetime(2025, 1, 1)))
    assert state_of(modes.apply_mode("FULL_SNAPSHOT", target, batch)) == [(2, "b", 2)]
    assert modes.apply_mode("whatever", target, batch).columns == [*target.columns, modes.PROCESS_DATE]
    assert modes.apply_mode("APPEND", target, batch).count() == 2
    assert values(modes.apply_mode("APPEND", None, batch), "id") == [2]


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(10_000).select(F.lit(1).alias("id"), F.col("id").alias("at"))
    plan = modes.newest_per_key(df, ["id"], [F.col("at")])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
