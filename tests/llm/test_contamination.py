import hashlib

import pytest

from tests.llm.corpus import ALNUM, LOWER, frame, rows
from tidegate.llm import contamination


def words(text):
    return ALNUM.findall((text or "").translate(LOWER))


ITEMS = [(1, None), (2, ""), (3, "One"), (4, "two WORDS"), (None, "a b c d"), (5, "Edit... edit"), (6, "zzz never"), (7, "a"), (7, "b")]


def items():
    long = next(t for d, t in rows() if d == 12)
    return ITEMS + [(8, long), (9, long.upper()), (10, " ".join(long.split()[:12]))]


def expected(data, tests, size=10):
    windows = {}
    for item, text in tests:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1) if n else ():
            # An item without id hits, but has no place in the list.
            windows.setdefault(tuple(w[i:i + n]), set()).update([str(item)] if item is not None else [])
    out = []
    for d, text in data:
        w, found = words(text), set()
        hit = [False] * len(w)
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    found |= windows[tuple(w[i:i + n])]
                    hit[i:i + n] = [True] * n
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("item_bytes, candidates, segment", [(8 << 20, 1_000_000, 4 << 20), (600, 5, 2000)])
def test_equals_brute_force(spark, monkeypatch, item_bytes, candidates, segment):
    monkeypatch.setattr(contamination, "ITEM_BYTES", item_bytes)
    monkeypatch.setattr(contamination, "CANDIDATES", candidates)
    monkeypatch.setattr(contamination, "SEGMENT_BYTES", segment)
    tests = spark.createDataFrame(items(), "item_id long, text string").selectExpr("*", "1 AS id", "'x' AS words")
    got = contamination.contamination(frame(spark, rows()), tests)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows(), items())


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = contamination.contamination(frame(spark, rows()), none).collect()
    assert len(got) == len(rows()) and not any(r["contaminated"] for r in got)
    assert contamination.contamination(frame(spark, []), none).count() == 0


def test_proximity(spark):
    data = [(1, "red x x green x blue"), (2, "red x x x x x x x green blue"), (3, "blue green red"), (4, "red green"), (5, None)]
    index = contamination.build_index(frame(spark, data))
    items = spark.createDataFrame([(1, "green red blue"), (2, "missing")], "item_id long, text string")

    def near(within):
        return {r["doc_id"] for r in contamination.find_near(index, items, within).collect()}
    assert near(2) == {3} and near(5) == {1, 3} and near(100) == {1, 2, 3}
