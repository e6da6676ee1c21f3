import numpy as np

from tests.llm.corpus import BLANKS, LOWER, frame, least_components, rows
from tidegate.llm import neardup
from tidegate.llm.components import components


def shingle_set(text):
    words = BLANKS.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def expected(data):
    sets = [(d, shingle_set(t)) for d, t in data]
    pairs = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if a is not None and b is not None and x and y and 100 * len(x & y) >= 85 * len(x | y)]
    part = least_components({d for d, _ in data if d is not None}, pairs)
    return sorted(((d, len(s), part.get(d), part.get(d) == d) for d, s in sets), key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_equals_brute_force(spark):
    assert found(neardup.near_duplicates(frame(spark, rows()))) == expected(rows())


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(neardup, "TILE_ROWS", 3)
    monkeypatch.setattr(neardup, "TILE_COLUMNS", 50)
    assert found(neardup.near_duplicates(frame(spark, rows(120, 3)))) == expected(rows(120, 3))


def test_empty_table(spark):
    df = neardup.near_duplicates(frame(spark, []))
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"] and df.count() == 0


def test_one_minhash_collection_agrees_as_often_as_sets_do(spark):
    data = [(1, " ".join(map(str, range(1000)))), (2, " ".join(map(str, range(100, 1100))))]
    bands = [np.array(r["bands"]) for r in neardup.signatures(frame(spark, data, False)).orderBy("doc_id").collect()]
    assert len(bands[0]) == neardup.GROUPS and 1 <= (bands[0] == bands[1]).sum() <= 11


def test_components_of_paths_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(40, 80)] + [(5, i) for i in range(100, 140)] + [(7, 7), (None, 3), (200, 201), (201, 202), (202, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == least_components(got, [(a, b) for a, b in edges if a is not None and a != b])
    assert 7 not in got and 3 not in got


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_rows_count_once_in_a_unit(spark):
    near = [" ".join(f"w{i}" for i in range(100)) + f" {k}" for k in range(3)]
    data = [(5, near[0])] * 2000 + [(6, near[1]), (7, near[2]), (8, "other words that link with nothing at all")]
    got = neardup.near_duplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(8)).collect()
    assert {r.doc_id: (r.component_id, r.kept) for r in got} == {5: (5, True), 6: (5, False), 7: (5, False), 8: (8, True)} and len(got) == len(data)
    import pyarrow as pa
    batch = pa.table({"unit": ["u"] * 5, "doc": [1, 1, 1, 2, 2], "side": [0, 0, 0, 0, 0], "text": ["a", "a", "b", "b", "b"]}).to_batches()[0]
    assert [len(rows) for rows in neardup._consecutive([batch, batch.slice(3)])] == [3]
