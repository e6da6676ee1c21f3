import hashlib

import numpy as np
import pytest

from tests.llm.corpus import BLANKS, frame, rows
from tidegate.llm import substrings


def expected(data, window=50):
    split = [(d, BLANKS.findall(t or "")) for d, t in data]
    first = {}
    for d, words in split:
        for i in range(len(words) - window + 1) if d is not None else ():
            key = tuple(words[i:i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1) if d is not None else ():
            if first[tuple(words[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((d, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot, shard", [(4000, 400_000), (2, 500)])
def test_equals_brute_force(spark, monkeypatch, hot, shard):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard)
    got = substrings.deduplicated(frame(spark, rows()))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows())


def test_repeated_rows_and_periodic_text(spark, monkeypatch):
    base = [f"w{i}" for i in range(90)]
    data = [(2, " ".join(base))] * 2000 + [(1, " ".join(base[5:70])), (3, "la " * 100_000), (4, "x " + "la " * 60), (5, "la li " * 20_000), (6, "li la " * 60 + "z")]
    got = substrings.deduplicated(spark.createDataFrame(data, "doc_id long, text string").repartition(8)).collect()
    assert sorted(map(tuple, got), key=str) == expected(data)
    hashes = np.array([7] * 100_000, np.uint64)
    anchors, low, high = substrings.anchors_of(hashes)
    assert len(anchors) == 10 and low[0] == 0 and high[-1] == 100_000 - 50 and (low[1:] == high[:-1] + 1).all()


def test_kept_text_and_columns(spark):
    df = substrings.deduplicated(frame(spark, rows()), keep=("doc_id", "text", "row"))
    assert df.columns == ["doc_id", "text", "row", "n_words", "n_removed", "kept_sha256", "kept"]
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] and r["row"] == "x" for r in df.collect())


def test_empty_table(spark):
    assert substrings.deduplicated(frame(spark, [])).count() == 0


def test_wavelet_ranks():
    random = np.random.default_rng(1)
    for size in (1, 2, 3, 17, 200):
        values = random.integers(0, size, 1000)
        value, at = random.integers(0, size, 300), random.integers(0, 1001, 300)
        assert substrings.Wavelet(values, size).rank(value, at).tolist() == [int((values[:i] == v).sum()) for v, i in zip(value, at)]


def test_backward_search_counts_occurrences():
    random = np.random.default_rng(2)
    text = np.append(random.integers(1, 4, 500), 0)
    index = substrings.Index(text, 4)
    for start in range(0, 400, 7):
        pattern = text[start:start + 6]
        low, high = np.array([0]), np.array([len(text)])
        for word in pattern[::-1]:
            low, high = index.prepend(np.array([word]), low, high)
        starts = sorted(i for i in range(len(text) - 5) if (text[i:i + 6] == pattern).all())
        assert sorted(index.order[low[0]:high[0]].tolist()) == starts


def test_equal_windows_have_equal_anchors():
    random = np.random.default_rng(3)
    shared = random.integers(1, 1 << 60, 80, dtype=np.uint64)

    def anchors(before):
        text = np.concatenate([random.integers(1, 1 << 60, before, dtype=np.uint64), shared])
        found = substrings.anchors_of(text)
        by_window = {int(w): int(a) for a, low, high in zip(*found) for w in range(low, high + 1)}
        assert sorted(by_window) == list(range(len(text) - 49))
        return [by_window[before + i] for i in range(31)]
    assert anchors(0) == anchors(33) == anchors(500)
