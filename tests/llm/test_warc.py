import gzip
import os

import pytest
from pyspark.sql import functions as F

from tidegate.llm import queries, warc

ROWS = [(i, f"http://h/{i}", "<p>" + "x" * (i % 7) + "</p>") for i in range(200)] + [(None, None, None), (5, "http://h/5", "<p>xxxxx</p>"), (300, "u", ""), (301, "u", "y" * 200_000)]


@pytest.fixture
def collection(spark, tmp_path):
    folders = [f"file://{tmp_path}/{n}" for n in "ab"]
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "'x' AS file", "1 AS nth", "2 AS digest")
    # Several files: small partitions would be put together.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    index = warc.write_collection(pages, folders, F.lit(False))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return index, folders, tmp_path


def located(index, folders):
    return {(r["file"], r["nth"]) for r in warc.audit(index, *folders).collect()}


def test_equal_replicas(collection):
    index, folders, _ = collection
    assert index.count() == len(ROWS) and located(index, folders) == set()


def test_records_are_whole_gzip_members(collection):
    index, _, root = collection
    for r in index.collect():
        with open(root / "a" / r["file"], "rb") as file:
            file.seek(r["offset"])
            text = gzip.decompress(file.read(r["length"]))
        assert text.startswith(b"WARC/1.0\r\n") and text.endswith(b"\r\n\r\n")


def test_changed_short_and_missing_files(collection):
    index, folders, root = collection
    rows = sorted((tuple(r) for r in index.select("file", "nth", "offset", "length").collect()))
    files = sorted({r[0] for r in rows})
    hurt = [r for r in rows if r[0] == files[0]]
    data = bytearray((root / "b" / files[0]).read_bytes())
    data[hurt[3][2]] ^= 255
    (root / "b" / files[0]).write_bytes(data)
    want = {hurt[3][:2]}
    assert len(files) > 3
    short = [r for r in rows if r[0] == files[1]]
    os.truncate(root / "b" / files[1], short[-1][2] + 1)
    os.rename(root / "b" / files[2], root / "gone")
    with open(root / "b" / files[3], "ab") as file:
        file.write(b"more")
    behind = [r for r in rows if r[0] == files[3]][-1]
    assert located(index, folders) == want | {short[-1][:2], behind[:2]} | {r[:2] for r in rows if r[0] == files[2]}


def test_both_replicas_cut_at_the_same_place(collection):
    index, folders, root = collection
    rows = sorted((tuple(r) for r in index.select("file", "nth", "offset", "length").collect()))
    files = sorted({r[0] for r in rows})
    short = [r for r in rows if r[0] == files[1]]
    for name in "ab":
        os.truncate(root / name / files[1], short[-2][2] + 1)
        os.rename(root / name / files[0], root / f"gone-{name}")
    assert located(index, folders) == {r[:2] for r in short[-2:]} | {r[:2] for r in rows if r[0] == files[0]}


def test_damaged_records_are_found(spark, tmp_path):
    folders = [f"file://{tmp_path}/{n}" for n in "ab"]
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    index = warc.write_collection(pages, folders, F.expr(queries.DECAY))
    got = warc.audit(index, *folders).join(index, ["file", "nth"]).select("page_id").collect()
    assert sorted(r[0] for r in got) == sorted(i for i, _, _ in ROWS if i is not None and i % 37 == 5)


def test_empty_table(spark, tmp_path):
    folders = [f"file://{tmp_path}/{n}" for n in "ab"]
    index = warc.write_collection(spark.createDataFrame([], "page_id long, url string, html string"), folders, F.lit(False))
    assert warc.audit(index, *folders).count() == 0
