import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.corpus import BLANKS, frame, rows
from tidegate.llm import runs
from tidegate.llm.words import mix


def brute(words, exponent, least):
    """Maximal stretches by comparing the sequence with itself at every distance."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def sequences(count, seed=3):
    pick = random.Random(seed)
    for _ in range(count):
        n, kinds = pick.randint(0, 150), pick.choice([1, 2, 2, 3, 5])
        words = [pick.randrange(kinds) for _ in range(n)]
        if n > 4 and pick.random() < 0.6:
            p, a = pick.randint(1, n // 4), pick.randint(0, n // 2)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        yield words


def prints(words):
    return mix(np.array(words, np.uint64) + np.uint64(1 << 40))


@pytest.mark.parametrize("exponent,least", [(2, 2), (2, 6), (3, 3), (4, 6)])
def test_streams_find_what_brute_force_finds(exponent, least):
    pick = random.Random(exponent)
    for words in sequences(250):
        stream, low = runs.Stream(exponent, least), 0
        while low < len(words):
            step = pick.choice([1, 3, 10, 40, 200])
            stream.append(prints(words[low:low + step]))
            low += step
        assert stream.runs() == brute(words, exponent, least)


def test_texts_that_share_a_stream():
    texts = list(sequences(120, seed=9))
    first = np.cumsum([0, *map(len, texts)])
    found = runs.runs_of_many(prints([w for t in texts for w in t]), first, 4, 6)
    assert [found.get(i, []) for i in range(len(texts))] == [brute(t, 4, 6) for t in texts]


def test_long_texts():
    n = 600_000
    assert runs.runs_of(prints([5] * n), 4, 6) == [(0, n, 1)]
    base = list(range(30_000))
    words = [90_000, *(base * 9), 90_001, *([1, 2] * 5000)]
    assert runs.runs_of(prints(words), 4, 6) == [(1, 270_000, 30_000), (270_002, 10_000, 2)]
    assert runs.Stream(4, 6).runs() == []
    with pytest.raises(ValueError):
        runs.Stream(1)


def planted_words(doc, words):
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark):
    odd = ["a a a a a", "a a a a a a", "b a a a a a a c", " ".join("ab" * 40), "x " * 300, "x y z\t" * 9 + "x y", "a a a a a a b b b b b b"]
    data = [(d, t) for d, t in rows(250) if d != 1000] + list(enumerate(odd, 3000))
    got = runs.digests(runs.periodic_runs(runs.planted(frame(spark, data)), 4, 6))
    want = []
    for d, text in data:
        words = planted_words(d, BLANKS.findall(text or ""))
        found = brute(words, 4, 6)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        want.append((d, len(found), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(kept.encode()).hexdigest()))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 20


def test_words_kept_and_empty_table(spark):
    found = runs.periodic_runs(frame(spark, [(1, "go  go go\ngo stop stop"), (2, None), (2, " ")]), 2, 2).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept) for r in found] == [(1, 6, [(0, 4, 1), (4, 2, 1)], "go stop"), (2, 0, [], ""), (2, 0, [], "")]
    assert runs.digests(runs.periodic_runs(runs.planted(frame(spark, [])))).count() == 0
