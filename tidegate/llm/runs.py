"""Periodic runs of words, found online by dyadic square catching.

Words are appended to a stream in pieces. For each power of two L the stream is cut into blocks of L words; a completed
block gets a catcher, which lives while the next 2L to 4L words arrive. Each appended word completes a suffix of L words,
and that suffix is compared (by fingerprint) with the blocks of the catchers alive at that place: two per level, three on the
lowest. A catcher that meets its block again at distance q has seen a part of a square of half length q; a square with 2L <= q < 4L
holds a whole block in its first half, so no square is missed. For powers higher than squares, several neighbouring blocks
have to be met at the same distance before the catch counts. A catch is extended to both sides by comparing
words; catches of one run merge, a run that touches the end of the stream goes on with the next piece, and a run found with
a multiple of its period is dropped. Work is O(n log n) for n words, memory about forty bytes a word.

A level's catchers advance together as numpy rows. Texts of usual length share a stream, with a word of its own kind between them; a long
text is a stream of its own, fed in pieces. Documents need nothing of each other: there is no shuffle.

Defined cases: null and texts without words have no runs and an empty rest; repeated rows are judged each by itself; only doc_id and text are
read, so other columns may have any name; an empty table gives an empty result. Among runs of equal power the one that
starts first, then the one with the smaller period, is the strongest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import map_arrow, texts
from tidegate.llm.words import BASE, NOT_BLANK, mix, pieces, words_of

# Texts of more words are streams of their own, appended in pieces of PIECE words.
LONG, PIECE = 4096, 1 << 18
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Level:
    """Fingerprints of the suffixes of `size` words, from the place `base` on."""

    def __init__(self, size: int, slots: tuple[int, ...], chain: int):
        self.size, self.slots, self.chain = size, slots, chain
        self.base, self.prints = 0, np.zeros(0, np.uint64)

    def grow(self, below: Level) -> None:
        """Add the suffixes that the level below has got."""
        half, known = self.size // 2, self.base + len(self.prints)
        a = below.prints[known - below.base:]
        if len(a) > half:
            fresh = mix(a[:len(a) - half] * np.uint64(BASE) + a[half:])
            self.prints = np.concatenate([self.prints, fresh])

    def trim(self) -> None:
        """Forget what no live catcher needs."""
        spare = (len(self.prints) - (self.chain + 6) * self.size) // self.size * self.size
        if spare > 0:
            self.prints, self.base = self.prints[spare:].copy(), self.base + spare

    def catches(self, fresh: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(start, end, period) of stretches in which enough blocks in a row were met again; `fresh`: first new suffix."""
        size, end = self.size, self.base + len(self.prints)
        row = max(self.base, (fresh - (self.chain - 1) * size) // size * size)
        for slot in self.slots:
            low = max(row, self.base + slot * size)
            if low >= end:
                continue
            inner = self.prints[low - self.base:]
            rows = -(-len(inner) // size)
            met = np.zeros(rows * size, bool)
            met[:len(inner)] = inner == np.repeat(self.prints[low - slot * size - self.base::size][:rows], size)[:len(inner)]
            met = met.reshape(rows, size)
            if rows < self.chain:
                continue
            kept = rows - self.chain + 1
            chained = met[:kept]
            for i in range(1, self.chain):
                chained = chained & met[i:kept + i]
            at = np.flatnonzero(chained.any(axis=0))
            if not len(at):
                continue
            hits = np.flatnonzero(chained[:, at].T)
            new = np.ones(len(hits), bool)
            new[1:] = (np.diff(hits) != 1) | (hits[1:] % kept == 0)
            first = hits[new]
            last = hits[np.append(np.flatnonzero(new)[1:], len(hits)) - 1]
            column = at[first // kept]
            begin = low + first % kept * size + column
            period = slot * size + column
            yield begin - period, begin + (last - first + self.chain) * size, period


class Stream:
    """Runs of a growing sequence of 64-bit words: stretches of at least `least` words and `exponent` periods."""

    def __init__(self, exponent: int = 2, least: int = 2, longest: int = 1 << 62):
        if exponent < 2:
            raise ValueError("squares are the lowest power that can be caught")
        self.exponent, self.least, self.longest = exponent, least, longest
        self.n, self.words, self.levels = 0, np.zeros(0, np.uint64), [Level(1, (1, 2, 3), exponent - 1)]
        self.found: dict[tuple[int, int], int] = {}
        # The longest run over each place, as its index in `known`; -1 where there is none.
        self.over, self.known = np.zeros(0, np.int64), np.zeros((0, 3), np.int64)

    def append(self, words: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self.words):
            room = max(self.n, min(2 * len(self.words), len(self.words) + (1 << 24)))
            self.words, self.over = np.resize(self.words, room), np.resize(self.over, room)
        self.words[old:self.n], self.over[old:self.n] = words, -1
        for (start, period), end in [item for item in self.found.items() if item[1] == old]:
            del self.found[start, period]
            self._keep(start, end + self._equal(end, period), period)
        below = self.levels[0]
        below.prints = np.concatenate([below.prints, words])
        size = 2
        while 2 * size * self.exponent <= min(self.n, self.longest):
            if size >> len(self.levels):
                self.levels.append(Level(size, (2, 3), 2 * self.exponent - 3))
                # A new level starts with what the level below still holds; that is all of it as long as nothing was trimmed there.
                self.levels[-1].base = -(-self.levels[-2].base // size) * size
            size *= 2
        seen = [level.base + len(level.prints) for level in self.levels]
        seen[0] = old
        for below, level in zip(self.levels, self.levels[1:]):
            level.grow(below)
        for level, fresh in zip(self.levels, seen):
            for begin, end, period in level.catches(fresh):
                self._merge(begin, end, period)
        for level in self.levels:
            level.trim()

    def _merge(self, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """Extend what was caught; catches inside a known run with a divisor of their period are that run once more."""
        if len(self.known):
            run = self.known[self.over[(begin + end) // 2]]
            inside = (self.over[(begin + end) // 2] >= 0) & (run[:, 0] <= begin) & (end <= run[:, 1]) & (period % run[:, 2] == 0)
            begin, end, period = begin[~inside], end[~inside], period[~inside]
        for a, b, q in zip(begin.tolist(), end.tolist(), period.tolist()):
            self._keep(a - self._equal_before(a, q), b + self._equal(b, q), q)

    def _keep(self, start: int, end: int, period: int) -> None:
        """Note a run. Less than a square counts only as long as the next words may complete it."""
        whole = end - start >= 2 * period
        if self.found.get((start, period), 0) >= end or not (whole or end == self.n):
            return
        self.found[start, period] = end
        if not whole:
            return
        part = self.over[start:end]
        lengths = self.known[:, 1] - self.known[:, 0]
        shorter = part < 0
        shorter[~shorter] = lengths[part[~shorter]] < end - start
        part[shorter] = len(self.known)
        self.known = np.concatenate([self.known, [[start, end, period]]])

    def _equal(self, place: int, period: int) -> int:
        """How many words from a place on equal the words a period before."""
        count, step = 0, 64
        while place + count < self.n:
            stop = min(self.n, place + count + step)
            differ = np.flatnonzero(self.words[place + count:stop] != self.words[place + count - period:stop - period])
            if len(differ):
                return count + int(differ[0])
            count, step = stop - place, step * 2
        return count

    def _equal_before(self, place: int, period: int) -> int:
        """How many words before a place equal the words a period after."""
        count, step = 0, 64
        while count < place:
            low = max(0, place - count - step)
            differ = np.flatnonzero(self.words[low:place - count] != self.words[low + period:place - count + period])
            if len(differ):
                return place - low - 1 - int(differ[-1])
            count, step = place - low, step * 2
        return count

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period), in order of start and period."""
        least: dict[tuple[int, int], int] = {}
        for (start, period), end in self.found.items():
            if end - start >= max(self.least, self.exponent * period):
                least[start, end] = min(period, least.get((start, end), period))
        return sorted((start, end - start, period) for (start, end), period in least.items())


def runs_of(prints: np.ndarray, exponent: int, least: int) -> list[tuple[int, int, int]]:
    """Runs of one text, appended piece by piece."""
    stream = Stream(exponent, least, len(prints))
    for low in range(0, len(prints), PIECE):
        stream.append(prints[low:low + PIECE])
    return stream.runs()


def runs_of_many(prints: np.ndarray, first: np.ndarray, exponent: int, least: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of several texts by their number; text i has the words first[i]:first[i + 1]."""
    sizes, found = np.diff(first), {}
    for i in np.flatnonzero(sizes > LONG).tolist():
        found[i] = runs_of(prints[first[i]:first[i + 1]], exponent, least)
    short = np.flatnonzero((sizes <= LONG) & (sizes >= max(least, exponent)))
    if len(short):
        # Each text is followed by a word that stands nowhere else.
        sizes = sizes[short]
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        words = np.empty(starts[-1], np.uint64)
        words[starts[1:] - 1] = mix(np.arange(len(short), dtype=np.uint64))
        inner = np.arange(sizes.sum()) + np.repeat(np.arange(len(short)), sizes)
        words[inner] = prints[inner - np.repeat(starts[:-1], sizes) + np.repeat(first[short], sizes)]
        stream = Stream(exponent, least, int(sizes.max()))
        stream.append(words)
        for start, length, period in stream.runs():
            i = int(np.searchsorted(starts, start, side="right")) - 1
            found.setdefault(int(short[i]), []).append((start - int(starts[i]), length, period))
    return found


def without_repeats(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words of a text joined by a blank, of each run only its first period."""
    words = text.split()
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, exponent: int = 2, least: int = 2) -> DataFrame:
    """doc_id, n_words, runs (start, length, period, in order of start and period) and kept, the words left when of each run only
    the first period stays."""
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                words = words_of(part.column(1), NOT_BLANK, lower=False)
                found = runs_of_many(words.hashes(), words.first, exponent, least)
                rows = part.column(1).cast(pa.binary()).to_pylist()
                runs = [found.get(i, []) for i in range(len(rows))]
                kept = [without_repeats(text or b"", own) for text, own in zip(rows, runs)]
                flat = np.array([r for own in runs for r in own], np.int64).reshape(-1, 3)
                ends = np.cumsum([0, *map(len, runs)])
                structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(words.first), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "kept"])

    return map_arrow(texts(docs), run, f"doc_id {kind.simpleString()}, n_words bigint, runs {RUNS}, kept string")


def strongest(runs: Column) -> Column:
    """The run with the most periods; NULL without runs. Fractions are compared exactly."""
    def before(a, b):
        more = a["length"] * b["period"] - b["length"] * a["period"]
        tie = F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])
        return F.when(more > 0, -1).when(more < 0, 1).when(tie < 0, -1).when(tie > 0, 1).otherwise(0)
    return F.get(F.array_sort(runs, before), F.lit(0))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which every tenth document (by the checksum of its id) goes on from a word of its own as copies of
    a stretch of its own: a rehearsal of degenerate text."""
    mark = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    plain = texts(docs).withColumn("mark", mark)
    chosen = F.col("mark") % 10 == 0
    cut = plain.withColumn("words", F.when(chosen, words)).withColumn("n", F.when(chosen, F.size("words").cast("long")))
    g = F.floor(F.col("mark") / 10)
    a = g % F.col("n")
    begun = cut.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int")), times))
    rest = F.slice(repeated, F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), rest), " ")
    return begun.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The strongest run and checksums of all runs and of the words kept."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))
