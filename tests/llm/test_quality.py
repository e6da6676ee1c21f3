from tests.llm.corpus import frame, rows
from tidegate.llm import quality

TABLES = "/root/testdata/sf0.1"
FEW = quality.Settings(buckets=1 << 14, steps=300)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    poor, good = [[r["predicted"] for r in got if r["quality"] == q] for q in (0, 1)]
    assert len(got) > 1000 and sum(poor) / len(poor) < 0.05 and sum(good) / len(good) > 0.99


def test_odd_rows(spark):
    labels = spark.createDataFrame([(8, 1), (8, 1), (12, 0), (13, 1), (1, 0), (None, 1), (14, None), (15, 7), (1000, 0)], "doc_id long, quality int")
    df = quality.quality_scores(frame(spark, rows()), labels.selectExpr("*", "'x' AS text", "'y' AS label"), FEW)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    got = df.collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_scores(frame(spark, []), labels, FEW).count() == 0
    assert {r["score"] for r in quality.quality_scores(frame(spark, rows()), labels, FEW).collect()} == {0.5}


def test_scores_are_those_of_averaged_vectors(spark):
    import numpy as np

    labels = spark.createDataFrame([(i, i % 2) for i in range(8, 60)], "doc_id long, quality int")
    docs = frame(spark, [r for r in rows() if r[0] and r[0] < 100])
    model = quality.fit(docs, labels, settings=FEW)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    for d, text in rows():
        if d and 20 < d < 40:
            buckets, counts = quality.document(text, FEW)
            hidden = (counts / counts.sum()) @ model.vectors[buckets]
            out = model.weights @ hidden + model.bias
            assert abs(got[d] - 1 / (1 + np.exp(out[0] - out[1]))) < 1e-5
