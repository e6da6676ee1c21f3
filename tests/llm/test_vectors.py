import math

import numpy as np

from tests.llm.corpus import least_components
from tidegate.llm import vectors


def data(n=300, seed=4):
    random = np.random.default_rng(seed)
    centers = random.normal(size=(12, 16))
    out = []
    for i in range(n):
        x = centers[random.integers(12)] + random.normal(size=16) * random.choice([0.02, 0.1, 0.2, 1.0])
        out.append((i, [float(v) for v in np.float32(x * random.choice([1, 3]))], int(random.integers(3))))
    out += [(n + k, out[5][1], out[5][2]) for k in range(20)]
    out += [(n + 30, None, 1), (n + 31, [0.0] * 16, 1), (n + 32, [math.nan] * 16, 1), (n + 33, [1.0, None] + [0.0] * 14, 1), (n + 34, [math.inf] * 16, 1),
            (n + 35, out[5][1], None), (n + 36, [], 1), (n + 37, [1.0, 2.0], 1), (n + 38, [2.0, 4.0], 1), (None, out[5][1], out[5][2])]
    return out


def expected(rows):
    def fine(i, v, label):
        return i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    good = [(i, np.array(v), label) for i, v, label in rows if fine(i, v, label)]
    pairs = [(a, b) for k, (a, x, p) in enumerate(good) for b, y, q in good[:k]
             if p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98]
    part = least_components({i for i, _, _ in rows if i is not None}, pairs)
    count = {i: sum(i in p for p in pairs) for i in part}
    return sorted(((i, count.get(i, 0), part.get(i), i is None or part[i] == i) for i, _, _ in rows), key=str)


def test_equals_brute_force(spark, monkeypatch):
    for block in (1024, 7):
        monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
        df = spark.createDataFrame(data(), "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS n", "'x' AS vector", "2 AS list")
        assert sorted(map(tuple, vectors.near_vectors(df).collect()), key=str) == expected(data())


def test_empty_table(spark):
    df = vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"] and df.count() == 0


def test_coded_distances_are_off_by_the_stored_error_at_most():
    random = np.random.default_rng(3)
    x = random.normal(size=(400, 20))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    book = vectors.Codebook(x[:200], 5)
    own, codes, error = book.encode(unit)
    for which in range(5):
        inside = own == which
        near, true = book.distances(unit, which, codes[inside]), np.linalg.norm(unit[:, None] - unit[inside][None], axis=2)
        assert (np.abs(near - true) <= error[inside][None] + 1e-9).all()


def test_probes_hold_every_partner():
    random = np.random.default_rng(5)
    x = random.normal(size=(500, 8))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    book = vectors.Codebook(x, 20)
    own, _, _ = book.encode(unit)
    probes = book.probes(unit, own, 0.5)
    for a, b in zip(*np.nonzero(np.linalg.norm(unit[:, None] - unit[None], axis=2) <= 0.5)):
        assert own[b] in probes[a] or own[a] in probes[b]
