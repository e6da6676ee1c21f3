"""Substring deduplication with compressed FM-indexes.

What has to be found: every run of WINDOW words that also starts in a document with a smaller id.

Routing. A window's anchor is the smallest hash among its GRAM-word runs, so equal windows have equal anchors wherever they
stand. Anchors that occur in one document only are dropped; around the others each document cuts out the words of the windows
they anchor, and these segments are dealt to shards by anchor. Everything equal to a window of a shard is in that shard.

Shard. The segments of a shard are indexed together: suffixes sorted by their first DEPTH words, the Burrows-Wheeler
transform in a wavelet matrix (one bit vector per bit of a word's number, with ranks from popcounts). All segments are
then streamed backwards through it, in step. Each step prepends a word to the interval by two ranks; an interval of
WINDOW words first drops its last word (the interval of one word less is looked up by row), so the matching statistic stays at
WINDOW and every window costs one step. Each interval carries the smallest document that has it.

Equal texts. Of documents with the same text (64-bit fingerprint and length) only the smallest is cut up.

Hot anchors. An anchor with more than HOT occurrences is spread over several shards. Each of these reports the windows
it saw first under a fingerprint (those of one document for each distinct window); their overall first document comes
from an aggregation by fingerprint, combined before its shuffle.

Defined cases: a null or wordless text has no words; shorter texts than a window keep everything; windows repeated within
one document, or in rows of the same id, are not removed; rows without id keep everything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import arrow_batch, ddl, map_arrow, map_groups, stored, texts
from tidegate.llm.words import BASE, NOT_BLANK, mix, pieces, shingles, words_of

WINDOW, GRAM, DEPTH = 50, 8, 64
HOT = 4000
SHARD_WORDS = 400_000
# Most windows of one range of equal anchors.
RANGE_WINDOWS = 10_000
# Last window of a range that covers a whole text, whatever its length.
WHOLE = (1 << 31) - 1
PLACE_BITS = np.uint64(24)


def anchors_of(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of one text: (hash, first window, last window) of each; windows are named by their first word."""
    grams = shingles(hashes, gram)
    span = window - gram + 1
    low = (grams >> PLACE_BITS << PLACE_BITS) | (np.arange(len(grams), dtype=np.uint64) & np.uint64((1 << 24) - 1))
    width, size = 1, len(grams)
    while width * 2 <= span:
        low = np.minimum(low[:len(low) - width], low[width:])
        width *= 2
    if width < span:
        rest = size - span + 1
        low = np.minimum(low[:rest], low[span - width:span - width + rest])
    starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    place = (low[starts] & np.uint64((1 << 24) - 1)).astype(np.int64)
    # Places count modulo 2**24; the anchor lies within the window.
    place = starts + ((place - starts) & ((1 << 24) - 1))
    # In periodic text the same words are an anchor again and again: neighbouring windows of equal anchors are one range, cut where it
    # grows long.
    anchor = grams[place]
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    anchor, starts = anchor[new], starts[new]
    count = -(-np.diff(np.append(starts, len(low))) // RANGE_WINDOWS)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    anchor, starts = np.repeat(anchor, count), np.repeat(starts, count) + step * RANGE_WINDOWS
    return anchor, starts, np.append(starts[1:], len(low)) - 1


class Wavelet:
    """Ranks in a sequence of numbers below `size`: a wavelet matrix of packed bit vectors."""

    def __init__(self, values: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.levels = []
        for level in reversed(range(self.bits)):
            bit = (values >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 - len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
            ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.levels.append((level, packed, ranks, len(values) - int(bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])
        self.base = self.descend(np.arange(size), np.zeros(size, np.int64))

    def descend(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, packed, ranks, zeros in self.levels:
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = ranks[block] + np.bitwise_count(packed[block] & mask)
            at = np.where(value >> level & 1, zeros + ones, at - ones)
        return at

    def rank(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each value occurs before each place."""
        return self.descend(value, at) - self.base[value]


class Index:
    """FM-index of a text of word numbers, for patterns of at most DEPTH words. Row order: by the first DEPTH words."""

    def __init__(self, text: np.ndarray, size: int):
        n = len(text)
        ranks, names, width = {1: text.astype(np.int64)}, text.astype(np.int64), 1
        order = np.argsort(names)
        while width < DEPTH:
            key = names * (n + size) + np.roll(names, -width)
            order = np.argsort(key)
            sorted_key = key[order]
            fresh = np.concatenate([[False], sorted_key[1:] != sorted_key[:-1]])
            names = np.empty(n, dtype=np.int64)
            names[order] = np.cumsum(fresh)
            width *= 2
            ranks[width] = names
        self.order, self.ranks = order, ranks
        self.wavelet = Wavelet(text[order - 1], size)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])

    def groups(self, depth: int) -> np.ndarray:
        """First row of each group of suffixes that share their first `depth` words (at most DEPTH)."""
        width = max(w for w in self.ranks if w <= depth)
        names = self.ranks[width]
        a, b = names[self.order], np.roll(names, width - depth)[self.order]
        return np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))

    def prepend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after one more word in front."""
        first = self.before[word]
        return first + self.wavelet.rank(word, low), first + self.wavelet.rank(word, high)


def window_firsts(segments: list[np.ndarray], size: int, docs: np.ndarray, window: int = WINDOW):
    """Of every window of the segments (word numbers from 1): (segment, start, interval, smallest document).

    The segments are indexed together and streamed through the index; docs are the ranks of their documents.
    """
    lengths = np.array([len(s) for s in segments])
    gap = np.zeros(1, dtype=np.int64)
    text = np.concatenate([x for s in segments for x in (s, gap)])
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
    index = Index(text, size)
    shorter, full = index.groups(window - 1), index.groups(window)
    n = len(text)
    row_group = np.searchsorted(shorter, np.arange(n), side="right") - 1
    low_of, high_of = shorter[row_group], np.append(shorter[1:], n)[row_group]
    owner = np.repeat(docs, lengths + 1)
    least = np.minimum.reduceat(owner[index.order], full)
    low, high = np.zeros(len(segments), np.int64), np.full(len(segments), n)
    out = []
    for step in range(int(lengths.max())):
        alive = np.flatnonzero(lengths > step)
        at = lengths[alive] - 1 - step
        a, b = low[alive], high[alive]
        if step >= window:
            a, b = low_of[a], high_of[a]
        a, b = index.prepend(text[begin[alive] + at], a, b)
        low[alive], high[alive] = a, b
        if step >= window - 1:
            out.append((alive, at, a, least[np.searchsorted(full, a, side="right") - 1]))
    return tuple(np.concatenate(x) for x in zip(*out))


def anchor_rows(docs: DataFrame) -> DataFrame:
    """anchor, doc_id, __row (fingerprint of the text), low, high (first and last window) of all anchors."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, limit=1 << 20):
                words = words_of(piece.column(1), NOT_BLANK, False)
                hashes, first, parts = words.hashes(), words.first, []
                for i in np.flatnonzero(np.diff(first) >= WINDOW):
                    found = anchors_of(hashes[first[i]:first[i + 1]])
                    parts.append((*found, np.full(len(found[0]), i)))
                if parts:
                    anchor, low, high, row = (np.concatenate(x) for x in zip(*parts))
                    yield arrow_batch(anchor=anchor.view(np.int64), doc_id=piece.column(0).take(pa.array(row)),
                                      __row=piece.column(2).take(pa.array(row)), low=low.astype(np.int32), high=high.astype(np.int32))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs, run, f"anchor long, doc_id {id_type}, __row long, low int, high int")


def cut_segments(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Words around the shared anchors: shard, hot, doc_id, __row, start, words."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        last = None
        for batch in batches:
            ids, rows, found = batch.column(0), batch.column(1), batch.column(3).to_pylist()
            source, shard, hot, start, words = [], [], [], [], []
            for i, (key, text) in enumerate(zip(zip(ids.to_pylist(), rows.to_pylist()), batch.column(2).to_pylist())):
                # Repeated rows follow each other; one of them is cut up.
                if key == last:
                    continue
                last = key
                split = text.encode("utf-8").split()
                for place in found[i]:
                    source.append(i)
                    shard.append(place["shard"])
                    hot.append(place["hot"])
                    start.append(place["low"])
                    words.append(b" ".join(split[place["low"]:place["high"] + WINDOW]))
            at = pa.array(source, pa.int64())
            yield arrow_batch(shard=pa.array(shard, pa.int32()), hot=pa.array(hot, pa.bool_()), doc_id=ids.take(at), __row=rows.take(at),
                              start=pa.array(start, pa.int32()), words=pa.array(words, pa.binary()))

    joined = docs.join(places, ["doc_id", "__row"]).select("doc_id", "__row", "text", "found").sortWithinPartitions("doc_id", "__row")
    return map_arrow(joined, run, f"shard int, hot boolean, doc_id {id_type}, __row long, start int, words binary")


def search_shards(segments: DataFrame) -> DataFrame:
    """Per shard: windows with a smaller document, as ranges (low, high of their first words, print null), and for hot
    anchors the first sight of each other window (low, its fingerprint print)."""
    id_type = segments.schema["doc_id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("doc_id").combine_chunks()
        ranked = pa.compute.rank(ids, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)
        numbers: dict[bytes, int] = {}
        lists = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in words.split()], dtype=np.int64)
                 for words in table.column("words").to_pylist()]
        segment, at, _, least = window_firsts(lists, len(numbers) + 1, ranked)
        start = table.column("start").to_numpy().astype(np.int64)
        hot = table.column("hot").to_numpy(zero_copy_only=False)
        order = np.lexsort((at, segment))
        segment, at, least = segment[order], at[order], least[order]
        again = least < ranked[segment]
        # Runs of neighbouring windows of a segment.
        edge = np.ones(len(segment), bool)
        edge[1:] = (segment[1:] != segment[:-1]) | (again[1:] != again[:-1])
        run_start = np.flatnonzero(edge)
        run_end = np.append(run_start[1:], len(segment)) - 1
        chosen = again[run_start]
        lows, highs, owners = at[run_start][chosen], at[run_end][chosen], segment[run_start][chosen]
        # First sights of hot windows; a document that repeats one has several.
        fresh = np.flatnonzero(hot[segment] & ~again)
        prints = np.zeros((2, len(fresh)), np.uint64)
        if len(fresh):
            words = words_of(pa.array([b" ".join(numbers).decode("utf-8", "surrogateescape")], pa.large_string()), NOT_BLANK, False)
            value = np.concatenate([[np.uint64(0)], words.hashes()])
            text = np.concatenate(lists)
            begin = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            for k, seed in enumerate((np.uint64(1), np.uint64(BASE))):
                total = shingles(mix(value[text] + seed), WINDOW)
                prints[k] = total[begin[segment[fresh]] + at[fresh]]
        owner = np.concatenate([owners, segment[fresh]])
        low = np.concatenate([lows, at[fresh]]) + start[owner]
        high = np.concatenate([highs, at[fresh]]) + start[owner]
        seen = np.concatenate([np.zeros(len(owners), bool), np.ones(len(fresh), bool)])
        pad = np.zeros(len(owners), np.int64)
        out = {"doc_id": ids.take(pa.array(owner)), "__row": table.column("__row").combine_chunks().take(pa.array(owner)),
               "low": pa.array(low.astype(np.int32)), "high": pa.array(high.astype(np.int32)),
               "print_1": pa.array(np.concatenate([pad, prints[0].view(np.int64)]), mask=~seen),
               "print_2": pa.array(np.concatenate([pad, prints[1].view(np.int64)]), mask=~seen)}
        return pa.table(out)

    return map_groups(segments, "shard", run, f"doc_id {id_type}, __row long, low int, high int, print_1 long, print_2 long")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, __row, low, high): ranges of windows that also start in a document with a smaller id; WHOLE as high stands
    for the last window.

    docs: doc_id, text, __row (fingerprint of the text).
    """
    anchors = stored(anchor_rows(docs.where("doc_id IS NOT NULL")), "anchors")
    shared = stored(anchors.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"),
                                                  F.sum(F.col("high") - F.col("low") + WINDOW).alias("words"))
                    .where("least != most").select("anchor", "n", "words"), "shared")
    # Of equal texts only the smallest document is cut up; every window of the others is a repeat.
    texts_of = docs.where("doc_id IS NOT NULL").select("doc_id", "__row", F.octet_length("text").alias("size"))
    same = texts_of.groupBy("__row", "size").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least != most")
    copies = stored(texts_of.join(same, ["__row", "size"]).where("doc_id > least").select("doc_id", "__row").distinct(), "copies")
    total = shared.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_WORDS))
    parts = F.greatest(F.ceil(F.col("n") / HOT), F.ceil(F.col("words") / SHARD_WORDS)).cast("int")
    part = F.pmod(F.xxhash64("doc_id", "__row", "low"), parts)
    # A set: repeated rows have the same places.
    places = (anchors.join(shared, "anchor")
              .groupBy("doc_id", "__row").agg(F.collect_set(F.struct(
                  "low", "high", F.pmod(F.xxhash64("anchor", part), F.lit(shards)).cast("int").alias("shard"), (parts > 1).alias("hot"))).alias("found"))
              .join(copies, ["doc_id", "__row"], "left_anti"))
    searched = stored(search_shards(cut_segments(docs, places)), "repeats")
    near = searched.where("print_1 IS NULL").select("doc_id", "__row", "low", "high")
    first = searched.where("print_1 IS NOT NULL")
    least = first.groupBy("print_1", "print_2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least != most")
    far = first.join(least, ["print_1", "print_2"]).where("doc_id > least").select("doc_id", "__row", "low", "high")
    whole = copies.select("doc_id", "__row", F.lit(0).alias("low"), F.lit(WHOLE).alias("high"))
    return near.unionByName(far).unionByName(whole)


def deduplicated(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document; with columns to keep also those, and kept (the words that
    stay, joined by one blank)."""
    read = texts(docs, keep).withColumn("__row", F.xxhash64("text"))
    ranges = repeated_windows(read.select("doc_id", "text", "__row")).groupBy("doc_id", "__row").agg(
        F.collect_list(F.struct("low", "high")).alias("found"))
    carried = [c for c in keep if c not in ("doc_id", "text")]
    shown = ["doc_id", *(["text", *carried] if keep else [])]
    joined = read.join(ranges, ["doc_id", "__row"], "left").select("doc_id", "text", "found", *carried)

    def run(batches):
        for batch in batches:
            count, removed, digest, kept = [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (text or "").encode("utf-8").split()
                count.append(len(words))
                if found:
                    edge, last = np.zeros(len(words) + 1, dtype=np.int64), len(words) - WINDOW
                    ranges_of = [(r["low"], min(r["high"], last)) for r in found if r["low"] <= last]
                    np.add.at(edge, [low for low, _ in ranges_of], 1)
                    np.add.at(edge, [high + WINDOW for _, high in ranges_of], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                removed.append(count[-1] - len(words))
                rest = b" ".join(words)
                digest.append(hashlib.sha256(rest).hexdigest())
                if keep:
                    kept.append(rest.decode("utf-8"))
            out = {n: batch.column(n) for n in shown} | {"n_words": pa.array(count, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                                                        "kept_sha256": pa.array(digest, pa.string())}
            yield arrow_batch(**out, **({"kept": pa.array(kept, pa.string())} if keep else {}))

    schema = f"{ddl(read, shown)}, n_words long, n_removed long, kept_sha256 string" + (", kept string" if keep else "")
    return map_arrow(joined, run, schema)
