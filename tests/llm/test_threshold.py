import corpus_pipeline
from tests.llm.corpus import frame, least_components, rows
from tests.llm.test_neardup import found, shingle_set
from tidegate.llm import neardup

PAIRS = 40


def pairs(shared):
    """Pairs of documents with `shared` of 100 shingles in common; ids 2k and 2k + 1."""
    own = (100 - shared) // 2
    out = []
    for k in range(PAIRS):
        def text(a, b, k=k):
            return " ".join(f"w{k}x{i}" for i in range(a, b + 4))
        out += [(2 * k, text(0, 100 - own)), (2 * k + 1, text(own, 100))]
    x, y = (shingle_set(t) for _, t in out[:2])
    assert (len(x & y), len(x | y)) == (shared, 100)
    return out


def kept(spark, data):
    docs = frame(spark, data).selectExpr("doc_id", "text", "'en' AS lang", "'x' AS source", "length(text) AS n_chars")
    return {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()}


def test_stage_drops_near_copies_from_80_percent_on(spark):
    for shared in (80, 82, 84):
        assert kept(spark, pairs(shared)) == {2 * k for k in range(PAIRS)}
    assert kept(spark, pairs(78)) == set(range(2 * PAIRS))


def test_op5_links_from_85_percent_on(spark):
    assert neardup.near_duplicates(frame(spark, pairs(84))).where("NOT kept").count() == 0
    assert neardup.near_duplicates(frame(spark, pairs(86))).where("NOT kept").count() == PAIRS


def test_lower_threshold_reaches_blocks_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 2000)
    data = rows(120, 3) + [(d + 2000, t) for d, t in pairs(80)]
    sets = [(d, shingle_set(t)) for d, t in data]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y)]
    part = least_components({d for d, _ in data if d is not None}, links)
    want = sorted(((d, len(s), part.get(d), part.get(d) == d) for d, s in sets), key=str)
    assert found(neardup.near_duplicates(frame(spark, data), 80, 16)) == want
