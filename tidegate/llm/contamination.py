"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: each run of texts becomes one segment, a row with its terms (64-bit fingerprints of
words, ascending), the offset of each term's postings, the postings (word positions within the segment, ascending) and
its documents. Segments are built where the texts are read and stored in the shared folder; nothing is shuffled.

A search brings phrases to every segment. A phrase's terms are taken from the rarest one (in that segment) on: the
postings of the rarest term, moved by its place in the phrase, are the candidate starts, and each further term keeps those
that its own postings confirm. All phrases of a segment are intersected together, in array operations, a bounded number
of candidates at a time. Proximity works alike with a distance instead of a fixed place.

Defined cases: a null or wordless text has no words and is in no match; phrases do not cross documents; an item without
words matches nothing, one without id hits but has no place in the list of items, and items with the same id count as one; a document stored twice is
reported twice.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import arrow_batch, map_arrow, stored, texts
from tidegate.llm.words import ALNUM, Words, pieces, words_of

WINDOW = 10
SEGMENT_BYTES = 4 << 20
# Rows of an index are large; small row groups bound what a reader holds.
ROW_GROUP_BYTES = 16 << 20
# Item text that one search holds in memory; more items are searched in several passes over the index.
ITEM_BYTES = 8 << 20
CANDIDATES = 1_000_000


@dataclass
class Segment:
    terms: np.ndarray
    starts: np.ndarray
    positions: np.ndarray
    first: np.ndarray

    def keys(self) -> np.ndarray:
        """(term number, position) of every posting as one ascending number."""
        return np.repeat(np.arange(len(self.terms)), np.diff(self.starts)) << 32 | self.positions

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Number of each term, or -1."""
        if not len(self.terms):
            return np.full(words.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, side="right") - 1


def build_segment(words: Words) -> Segment:
    terms, term = np.unique(words.hashes(), return_inverse=True)
    keys = np.sort(term.astype(np.int64) << 32 | np.arange(len(term)))
    starts = np.searchsorted(keys >> 32, np.arange(len(terms) + 1))
    return Segment(terms, starts, keys & 0xFFFFFFFF, words.first)


def build_index(docs: DataFrame) -> DataFrame:
    """Segments of all documents: segment (its name), doc_ids, first, terms, starts, positions (the last four as packed integers)."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, limit=SEGMENT_BYTES):
                s = build_segment(words_of(piece.column(1), ALNUM, True))
                packed = [s.first.astype("<i8"), s.terms.astype("<u8"), s.starts.astype("<i4"), s.positions.astype("<i4")]
                ids = piece.column(0)
                listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield arrow_batch(segment=[uuid.uuid4().hex], doc_ids=listed, **{n: pa.array([p.tobytes()], pa.binary())
                                                     for n, p in zip(("first", "terms", "starts", "positions"), packed)})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"segment string, doc_ids array<{id_type}>, first binary, terms binary, starts binary, positions binary"
    return stored(map_arrow(texts(docs), run, schema), "index", {"parquet.block.size": str(ROW_GROUP_BYTES)})


def segments(batches):
    """Segments of the batches of an index, each with its name and the ids of its documents."""
    for batch in batches:
        ids = batch.column(1)
        for i in range(batch.num_rows):
            packed = [np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in ((2, "<i8"), (3, "<u8"), (4, "<i4"), (5, "<i4"))]
            first, terms, starts, positions = packed
            listed = ids.values.slice(ids.offsets[i].as_py(), ids.offsets[i + 1].as_py() - ids.offsets[i].as_py())
            yield batch.column(0)[i].as_py(), listed, Segment(terms, starts.astype(np.int64), positions.astype(np.int64), first)


@dataclass
class Phrases:
    """Distinct phrases of one length: rows of term fingerprints, and the items each belongs to."""

    words: np.ndarray
    items: list[list[int]]


def windows_of(items: list[np.ndarray], size: int) -> list[Phrases]:
    """All runs of `size` words of the items, or the whole item where it is shorter, by length."""
    by_length: dict[int, dict[bytes, set[int]]] = defaultdict(lambda: defaultdict(set))
    for i, words in enumerate(items):
        n = min(size, len(words))
        for at in range(len(words) - n + 1 if n else 0):
            by_length[n][words[at:at + n].tobytes()].add(i)
    return [Phrases(np.frombuffer(b"".join(found), np.uint64).reshape(-1, n), [sorted(x) for x in found.values()])
            for n, found in sorted(by_length.items())]


def _rounds(counts: np.ndarray):
    """Cut rows into runs with about CANDIDATES postings in all."""
    total = np.cumsum(counts)
    at = 0
    while at < len(counts):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + CANDIDATES, side="right")))
        yield slice(at, stop)
        at = stop


def exact_matches(segment: Segment, keys: np.ndarray, phrases: np.ndarray):
    """Yield (phrase, start) arrays of the exact occurrences of the phrases."""
    size = phrases.shape[1]
    terms = segment.lookup(phrases)
    known = np.flatnonzero((terms >= 0).all(axis=1))
    terms = terms[known]
    counts = segment.starts[terms + 1] - segment.starts[terms]
    order = np.argsort(counts, axis=1, kind="stable")
    rows = np.arange(len(known))
    rarest = terms[rows, order[:, 0]] if len(known) else terms[:, 0]
    amount = segment.starts[rarest + 1] - segment.starts[rarest]
    for part in _rounds(amount):
        row = np.repeat(rows[part], amount[part])
        base = np.repeat(segment.starts[rarest[part]], amount[part])
        nth = np.arange(len(row)) - np.repeat(np.cumsum(amount[part]) - amount[part], amount[part])
        start = segment.positions[base + nth] - order[row, 0]
        keep = start >= 0
        row, start = row[keep], start[keep]
        for rank in range(1, size):
            place = order[row, rank]
            wanted = terms[row, place] << 32 | (start + place)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            keep = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
            row, start = row[keep], start[keep]
        inside = segment.document(start) == segment.document(start + size - 1)
        yield known[row[inside]], start[inside]


def near_matches(segment: Segment, keys: np.ndarray, words: np.ndarray, within: int):
    """(document, position) of the rarest of the words wherever all others occur in the same document, each at most
    `within` words away."""
    terms = np.unique(segment.lookup(words))
    if not len(terms) or terms[0] < 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    terms = terms[np.argsort(segment.starts[terms + 1] - segment.starts[terms], kind="stable")]
    at = segment.positions[segment.starts[terms[0]]:segment.starts[terms[0] + 1]]
    doc = segment.document(at)
    for term in terms[1:]:
        low = np.maximum(at - within, segment.first[doc])
        high = np.minimum(at + within, segment.first[doc + 1] - 1)
        keep = np.searchsorted(keys, term << 32 | low) < np.searchsorted(keys, term << 32 | high, side="right")
        at, doc = at[keep], doc[keep]
    return doc, at


def item_blocks(items: DataFrame, id_col: str, text_col: str):
    """Items in blocks of bounded size: (ids as text, word fingerprints) of each."""
    known = items.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).dropna(subset=["text"])
    size = known.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // ITEM_BYTES))
    for block in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        words = words_of(pa.array([r["text"] for r in rows], pa.large_string()), ALNUM, True)
        hashes = words.hashes()
        yield [r["id"] for r in rows], [hashes[a:b] for a, b in zip(words.first, words.first[1:])]


def find_windows(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, spans (word ranges inside occurrences of windows, merged), items (ids)."""
    id_type = index.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {id_type}, place string, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
    spark, found = index.sparkSession, None
    for ids, words in item_blocks(items, id_col, text_col):
        shared = spark.sparkContext.broadcast((ids, windows_of(words, size)))

        def run(batches, shared=shared):
            names, groups = shared.value
            for name, doc_ids, segment in segments(batches):
                keys = segment.keys()
                edge = np.zeros(len(segment.positions) + 1, dtype=np.int64)
                items_of: dict[int, set[str]] = defaultdict(set)
                for phrases in groups:
                    for phrase, start in exact_matches(segment, keys, phrases.words):
                        np.add.at(edge, start, 1)
                        np.add.at(edge, start + phrases.words.shape[1], -1)
                        pairs = np.unique(segment.document(start) * len(phrases.items) + phrase)
                        for doc, p in zip((pairs // len(phrases.items)).tolist(), (pairs % len(phrases.items)).tolist()):
                            items_of[doc].update(names[i] for i in phrases.items[p] if names[i] is not None)
                hit = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
                begins = np.flatnonzero(hit[1:-1] & ~hit[:-2])
                ends = np.flatnonzero(hit[1:-1] & ~hit[2:]) + 1
                spans = defaultdict(list)
                for a, b in zip(begins.tolist(), ends.tolist()):
                    # Neighbouring documents may both be hit at their common border.
                    for doc in range(int(segment.document(a)), int(segment.document(b - 1)) + 1):
                        low, high = int(segment.first[doc]), int(segment.first[doc + 1])
                        if max(a, low) < min(b, high):
                            spans[doc].append({"start": max(a, low) - low, "end": min(b, high) - low})
                n = len(doc_ids)
                yield arrow_batch(
                    doc_id=doc_ids, place=pa.array([f"{name}-{i}" for i in range(n)], pa.string()),
                    n_words=pa.array(np.diff(segment.first), pa.int64()),
                    spans=pa.array([spans.get(i, []) for i in range(n)], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    items=pa.array([sorted(items_of.get(i, ())) for i in range(n)], pa.list_(pa.string())))

        part = map_arrow(index, run, schema)
        found = part if found is None else merged(found, part)
    return found.drop("place")


def merged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Matches of two passes over the same index; overlapping spans are joined."""
    def run(batches):
        for batch in batches:
            spans = []
            for found in batch.column(3).to_pylist():
                out: list[dict] = []
                for s in sorted(found, key=lambda x: (x["start"], x["end"])):
                    if out and s["start"] <= out[-1]["end"]:
                        out[-1]["end"] = max(out[-1]["end"], s["end"])
                    else:
                        out.append(dict(s))
                spans.append(out)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(spans, batch.schema.field(3).type), batch.column(4)], schema=batch.schema)

    both = (left.unionByName(right).groupBy("place", "n_words").agg(
        F.first("doc_id").alias("doc_id"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        .select("doc_id", "place", "n_words", "spans", "items"))
    return map_arrow(both, run, left.schema)


def find_near(index: DataFrame, items: DataFrame, within: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Proximity: one row per (doc_id, item_id, position) where all words of an item stand close together."""
    id_type = index.schema["doc_ids"].dataType.elementType.simpleString()
    spark, found = index.sparkSession, None
    for ids, words in item_blocks(items, id_col, text_col):
        shared = spark.sparkContext.broadcast((ids, words))

        def run(batches, shared=shared):
            for _, doc_ids, segment in segments(batches):
                keys = segment.keys()
                for name, item in zip(*shared.value):
                    doc, at = near_matches(segment, keys, item, within)
                    if len(doc):
                        yield arrow_batch(doc_id=doc_ids.take(pa.array(doc)), item_id=pa.array([name] * len(doc), pa.string()),
                                          position=pa.array(at - segment.first[doc], pa.int64()))

        part = map_arrow(index, run, f"doc_id {id_type}, item_id string, position long")
        found = part if found is None else found.unionByName(part)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    found = find_windows(build_index(docs), benchmark, size=size)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
