from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.corpus import least_components
from tests.llm.test_contamination import words
from tests.llm.test_neardup import shingle_set
from tests.llm.test_substrings import expected as cut

FOLDER = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, FOLDER), name)
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    good, single, short, clean = kept
    assert all(q for d, q in labels.items() if d in good) and all(d in good for d, q in labels.items() if q)
    sets = {d: shingle_set(t) for d, t in good.items()}
    links = [(a, b) for a in good for b in good if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= corpus_pipeline.NEAR * len(sets[a] | sets[b])]
    part = least_components(good, links)
    assert set(single) == {d for d in good if part.get(d, d) == d} and len(single) < len(good)
    removed = {r[0]: r[2] for r in cut(list(single.items()))}
    assert all((d in short) == (removed[d] == 0 or removed[d] < len(t.split())) and (removed[d] or short[d] == t) for d, t in single.items())
    items = [words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    grams = {tuple(w[i:i + min(10, len(w))]) for w in items for i in range(len(w) - min(10, len(w)) + 1)}
    for d, text in short.items():
        w = words(text)
        assert (d in clean) == (not any(tuple(w[i:i + n]) in grams for n in {len(g) for g in grams} for i in range(len(w) - n + 1)))


def test_whole_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.where(F.col("n_tokens") > 0).count() == got.count() > 0
