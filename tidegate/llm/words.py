"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column, and a bounded memo for distinct words."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Texts are handled in pieces of about so many bytes, which bounds the temporary arrays of a Python worker.
CHUNK_BYTES = 2 << 20
HASH_WORDS = 50_000

# Multiplier of the rolling hash (odd, so that it has an inverse modulo 2**64) and of the final mixing.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def byte_table(members: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


# `[^\x20\x09-\x0D]+`: all but blanks.
NOT_BLANK = byte_table(b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D)
# `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`: digits, a-z and everything beyond ASCII; A-Z are lower-cased before.
ALNUM = byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        out = np.full(size, np.uint64(base), dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return run(BASE), run(BASE_INVERSE)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse; sizes are rounded up so that few tables exist."""
    up = max(1 << 16, 1 << int(size).bit_length())
    base, inverse = _powers(up)
    return base[:size], inverse[:size]


class Words:
    """Words of a run of texts.

    data: bytes (lower-cased if asked for); doc: index of each word's text; start, end: its bytes in data;
    first: index of each text's first word, with one more entry for the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, members: np.ndarray, lower: bool):
        n = len(data)
        inside = members[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        borders = offsets[:-1][(offsets[:-1] < n) & (offsets[:-1] < offsets[1:])]
        begins[borders] = inside[borders]
        last = borders[borders > 0] - 1
        ends[last] = inside[last]
        self.data = LOWER[data] if lower else data
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """64-bit fingerprint of every word."""
        if not len(self):
            return np.zeros(0, dtype=np.uint64)
        out = np.empty(len(self), dtype=np.uint64)
        for low in range(0, len(self), HASH_WORDS):
            # A run of words at a time: the sums take eight bytes for each byte of text.
            start, end = self.start[low:low + HASH_WORDS], self.end[low:low + HASH_WORDS]
            data = self.data[start[0]:end[-1]].astype(np.uint64)
            base, inverse = powers(len(data) + 1)
            total = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((data + np.uint64(1)) * base[:-1], out=total[1:])
            start, end = start - start[0], end - start[0]
            out[low:low + HASH_WORDS] = mix((total[end] - total[start]) * inverse[start])
        return out

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of the `size` words from each word on (the last size-1 positions are left out)."""
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        out = mix(out * np.uint64(BASE) + hashes[i:i + count])
    return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column without copying; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Split a batch into runs of rows whose texts hold about `limit` bytes; a longer text is a run of its own."""
    _, offsets = buffers(batch.column(batch.schema.get_field_index(column)))
    row, rows = 0, batch.num_rows
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), rows)
        yield batch.slice(row, stop - row)
        row = stop


def words_of(column: pa.Array, members: np.ndarray, lower: bool) -> Words:
    return Words(*buffers(column), members, lower)


def chunks(texts: list[str | None], chars: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts with about so many characters in all; null counts as empty."""
    held, size = [], 0
    for text in texts:
        text = text or ""
        if held and size + len(text) > chars:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


class Memo(dict):
    """What was computed for a word before, in two generations: when one holds too much it becomes the old one, from
    which words still in use are taken over, and the one before it is forgotten. So memory is bounded."""

    def __init__(self, compute: Callable[[list[str]], Iterable], entries: int = 300_000, chars: int = 12_000_000):
        super().__init__()
        self.compute, self.entries, self.chars, self.held = compute, entries, chars, 0
        self.old: dict = {}

    def values_of(self, lists: list[list[str]]) -> list[list]:
        """The value of every word of every list; those that are not known are computed together."""
        found = [list(map(self.get, words)) for words in lists]
        holes = [i for i, values in enumerate(found) if None in values]
        if not holes:
            return found
        missing = {w for i in holes for w, v in zip(lists[i], found[i]) if v is None}
        old = self.old
        fresh = {w: old[w] for w in missing if w in old}
        rest = [w for w in missing if w not in fresh]
        fresh.update(zip(rest, self.compute(rest)))
        size = sum(map(len, fresh))
        if len(self) + len(fresh) > self.entries or self.held + size > self.chars:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += size
        self.update(fresh)
        for i in holes:
            found[i] = [fresh[w] if v is None else v for w, v in zip(lists[i], found[i])]
        return found


def within(sizes: np.ndarray) -> np.ndarray:
    """Where each of several neighbours begins, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of an array, one after another."""
    begin = within(size)
    return flat[np.arange(begin[-1]) + np.repeat(start - begin[:-1], size)]


def coded_by_run(runs: Words, memo: Memo, dtype: str, end: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Packed values of all texts, one after another, each followed by `end`, and how many values each text has.

    Every distinct run of characters is looked up, or computed, once; the rest is copying.
    """
    # Here and not above, so that workers of other operators do without it.
    import pandas as pd

    code, distinct = pd.factorize(runs.hashes())
    sample = np.empty(len(distinct), np.int64)
    sample[code[::-1]] = np.arange(len(code))[::-1]
    raw = runs.data.tobytes()
    words = [raw[a:b].decode() for a, b in zip(runs.start[sample].tolist(), runs.end[sample].tolist())]
    coded = [*memo.values_of([words])[0], end] if words else [end]
    size = np.array([len(b) for b in coded], np.int64) // len(end)
    flat, place = np.frombuffer(b"".join(coded), dtype), within(size)
    # The end is one more run behind each text.
    code = np.insert(code, runs.first[1:], len(coded) - 1)
    return gathered(flat, place[code], size[code]), np.diff(within(size[code])[runs.first + np.arange(len(runs.first))])
