"""Quality classifier: supervised subword embeddings.

A word is the word itself plus its character n-grams, each hashed to a row of a learned table; two marks for repetition
count as words, too. A document is the average
of the rows of all its words; a softmax layer gives the class. Table and layer are trained together by stochastic
gradient descent in numpy, on a bounded sample of labelled documents (`per_class`); Spark finds the sample and turns
it into hashed features. Because the score of an average is the average of scores, table and layer are multiplied once
after training, and scoring adds up one number per word.

Defined cases: a null or blank text has no words and gets the score of the class shares alone; documents without id or
label are scored but not learned from; a document labelled twice counts with its lowest label, one stored twice with
its smallest text; without any labels every score is 0.5.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import arrow_batch, ddl, map_arrow, texts
from tidegate.llm.words import BASE, Memo, chunks, mix, powers

# Bound of the training sample: so many documents of each class, chosen by a hash of their id.
PER_CLASS = 800

# Two marks that count as words of their own, MARK_WEIGHT times each: a word that repeats the one before it, and a word
# in a line that occurs more than once in the document.
MARKS = ("\x01same", "\x01line")
MARK_WEIGHT = 8


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    dim: int = 16
    shortest: int = 3
    longest: int = 5
    steps: int = 20_000
    rate: float = 2.0
    per_class: int = PER_CLASS
    seed: int = 1


@dataclass
class Model:
    """vectors: one row per bucket; weights, bias: the softmax layer over the classes 0 and 1."""

    settings: Settings
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def folded(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the difference of the two classes' outputs, and that difference without words."""
        return self.vectors @ (self.weights[1] - self.weights[0]), float(self.bias[1] - self.bias[0])


def features(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, bucket) of the word itself and of every character n-gram of `<word>`."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = codes.astype(np.uint64)
    length = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    end = np.cumsum(length)
    base, inverse = powers(len(codes) + 1)
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes + np.uint64(1)) * base[:-1], out=total[1:])
    owner = np.repeat(np.arange(len(words)), length)
    stop = end[owner]
    at = np.arange(len(codes))
    indexes, hashes = [np.arange(len(words))], [mix((total[end] - total[end - length]) * inverse[end - length])]
    for n in range(s.shortest, s.longest + 1):
        first = at[at + n <= stop]
        indexes.append(owner[first])
        hashes.append(mix((total[first + n] - total[first]) * inverse[first] + np.uint64(n * BASE % (1 << 64))))
    return np.concatenate(indexes), (np.concatenate(hashes) % np.uint64(s.buckets)).astype(np.int64)


def marks(text: str, words: list[str]) -> tuple[int, int]:
    """How often each of MARKS counts in a text."""
    lines = Counter(text.split("\n"))
    repeated = sum(n * len(line.split()) for line, n in lines.items() if n > 1)
    return MARK_WEIGHT * sum(map(eq, words, words[1:])), MARK_WEIGHT * repeated


def document(text: str, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    buckets = features(words, s)[1]
    extra = np.repeat(mark_buckets(s), marks(text, words))
    found, counts = np.unique(np.concatenate([buckets, extra]), return_counts=True)
    return found.astype(np.int32), counts.astype(np.float32)


def mark_buckets(s: Settings) -> np.ndarray:
    index, bucket = features(list(MARKS), s)
    return bucket[:len(MARKS)]


def is_held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """Hashed features of the sampled documents: label, buckets (int32), counts (float32)."""
    known = (labels.groupBy("doc_id").agg(F.min("label").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)))
    sample = None
    for c in (0, 1):
        part = known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.per_class)
        sample = part if sample is None else sample.unionByName(part)
    chosen = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def run(batches):
        for batch in batches:
            rows = [[x.tobytes() for x in document(text or "", s)] for text in batch.column("text").to_pylist()]
            yield arrow_batch(doc_id=batch.column("doc_id").cast(pa.string()), label=batch.column("label").cast(pa.int32()),
                              buckets=pa.array([r[0] for r in rows], pa.binary()),
                              counts=pa.array([r[1] for r in rows], pa.binary()))

    return map_arrow(chosen, run, "doc_id string, label int, buckets binary, counts binary")


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], shares: tuple[int, int], s: Settings) -> Model:
    """Stochastic gradient descent, one document a step, with a rate that falls to zero.

    The sample holds the classes about equally; the bias is then moved to their shares among all labels.
    """
    random = np.random.default_rng(s.seed)
    vectors = (random.random((s.buckets, s.dim), dtype=np.float32) * 2 - 1) / np.float32(s.dim)
    weights, bias = np.zeros((2, s.dim), dtype=np.float32), np.zeros(2, dtype=np.float32)
    rows = [(y, b, c) for y, b, c in rows if len(b)]
    order: list[int] = []
    for step in range(s.steps if rows else 0):
        order = order or random.permutation(len(rows)).tolist()
        y, buckets, counts = rows[order.pop()]
        share = counts / counts.sum()
        rate = np.float32(s.rate * (1 - step / s.steps))
        hidden = share @ vectors[buckets]
        out = weights @ hidden + bias
        p = np.exp(out - out.max())
        p /= p.sum()
        p[y] -= 1
        back = p @ weights
        weights -= rate * np.outer(p, hidden)
        bias -= rate * p
        vectors[buckets] -= rate * np.outer(share, back)
    seen = [1 + sum(y == c for y, _, _ in rows) for c in (0, 1)]
    bias += np.log([(shares[c] + 1) / seen[c] for c in (0, 1)]).astype(np.float32)
    return Model(s, vectors, weights, bias)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings(),
        train_on: Column | None = None) -> Model:
    """Learn from the labelled documents; train_on: condition on the labels' doc_id."""
    known = labels.select(F.col("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    known = known if train_on is None else known.where(train_on)
    counts = {r["label"]: r["n"] for r in known.where(F.col("label").isin(0, 1)).groupBy("label").agg(F.count("*").alias("n")).collect()}
    rows = training_rows(texts(docs), known, settings).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return train([(r["label"], np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.float32)) for r in rows],
                 (counts.get(0, 0), counts.get(1, 0)), settings)


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns to keep and the score (probability of class 1) of every document, over its whole text."""
    s = model.settings
    shared = docs.sparkSession.sparkContext.broadcast(model.folded())
    read = texts(docs, keep)

    def run(batches):
        table, start = shared.value
        mark_values = table[mark_buckets(s)].tolist()

        def values(words):
            index, bucket = features(words, s)
            sums = np.bincount(index, weights=table[bucket], minlength=len(words))
            return (sums + 1j * np.bincount(index, minlength=len(words))).tolist()

        memo = Memo(values, entries=100_000, chars=4_000_000)
        for batch in batches:
            out = []
            for chunk in chunks(batch.column("text").to_pylist()):
                split = [text.split() for text in chunk]
                for text, words, found in zip(chunk, split, memo.values_of(split)):
                    total = sum(found, 0j)
                    for value, n in zip(mark_values, marks(text, words)):
                        total += n * (value + 1j)
                    out.append(start + (total.real / total.imag if words else 0.0))
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(0.5 * (1 + np.tanh(np.array(out) / 2)))], names=[*keep, "score"])

    return map_arrow(read, run, f"{ddl(read, keep)}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Learn `quality` from the documents that are not held out, score all: the columns to keep, held_out, score, predicted."""
    model = fit(docs, labels, settings=settings, train_on=~is_held_out(F.col("doc_id")))
    return score(docs, model, keep).select(*keep, is_held_out(F.col("doc_id")).alias("held_out"), "score",
                                           F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))
