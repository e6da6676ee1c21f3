"""Harmonic packing of tokenized documents into sequences of a fixed capacity.

Whole sequences are cut off a document that is longer than one. What remains, r ids, belongs to the reciprocal class k = capacity // r:
of class k exactly k documents share a sequence, whatever their lengths, so a sequence is filled by counting and workers need to know
nothing of each other. A sequence of class k leaves less than 1 / (k + 1) of its capacity empty. This gap is filled, too: documents
shorter than 1 / CLASSES of the capacity, those a class has left over, and the sequences with the widest gaps are taken apart as filler,
just as many as the other gaps take; their ids, one after another, are cut along the gaps. What filler is left makes full sequences
and, per block, one remainder, which is cut into sequences of powers of two. So no sequence needs padding: each is as long as the capacity or a
power of two. Most documents stay whole.

A worker packs blocks of about `block_ids` ids, so its memory does not grow with its partition. Sequence numbers are the partition's number times
2**33 plus a count; the same input gives the same numbers when a task is run again. There is no shuffle.

Encoding is the tokenizers library's. Where the model joins nothing across blanks and cuts letters from punctuation, every distinct run of characters of a
piece of texts is encoded once, and what it gave is remembered (a bounded memo); other models encode whole texts.

Defined cases: null is an empty text; an empty text has only the end id; repeated rows are packed each by itself; only doc_id and text are read, so other columns
may have any name; an empty table gives no pieces. Equal lengths keep the order of the rows.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import map_arrow, texts
from tidegate.llm.words import LOWER, Memo, Words, buffers, byte_table, coded_by_run, gathered, pieces, within

CAPACITY = 4096
# Documents shorter than this part of the capacity are filler from the start.
CLASSES = 32
BLOCK_IDS, BATCH_IDS, MEMO_RUNS = 2 << 20, 1 << 20, 500_000

# Where a run of characters begins: after a blank, or with punctuation after a letter.
BLANK = byte_table(b" \n")
LETTER = byte_table([*range(0x41, 0x5B), *range(0x61, 0x7B)])
POINT = byte_table(b".,!?;:|")
PIECE_BYTES = 4 << 20
# Rules under which runs can be encoded one by one (fixed values: they stand so in the model file).
BLANK_RULE = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Runs(Words):
    """Runs of characters that are encoded independently. Capitals become small letters where nothing can combine with them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n, inside = len(data), ~BLANK[data]
        borders = offsets[:-1][offsets[:-1] < n]
        after = np.ones(n, bool)
        after[1:] = ~inside[:-1] | (LETTER[data[:-1]] & POINT[data[1:]])
        after[borders] = True
        begins = inside & after
        ends = np.ones(n, bool)
        ends[:-1] = after[1:] | ~inside[1:]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(inside & ends) + 1
        alone = np.ones(n, bool)
        alone[:-1] = data[1:] < 0x80
        alone[borders[borders > 0] - 1] = True
        self.data = np.where(alone, LOWER[data], data)
        self.first = np.searchsorted(self.start, offsets)


class Coder:
    """Ids of texts, each followed by the end id."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        wide = max(self.tokenizer.get_vocab_size(), end_id + 1) > 1 << 16
        self.dtype, self.kind = ("<u4", "I") if wide else ("<u2", "H")
        self.end = array(self.kind, [end_id]).tobytes()
        rules = json.loads(self.tokenizer.to_str())
        steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_run = (rules.get("normalizer") == {"type": "Sequence", "normalizers": [{"type": "NFC"}, BLANK_RULE, {"type": "Lowercase"}]}
                       and steps[0].get("pattern") == {"Regex": WORD_RULE} and steps[0].get("behavior") == "Removed"
                       and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
                       and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space"))
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = Memo(self.pack_all, MEMO_RUNS)

    def pack_all(self, texts: list[str]) -> list[bytes]:
        return [array(self.kind, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column, one after another, and how many each text has; null counts as empty."""
        data, offsets = buffers(column)
        # An added token is found before the text is cut up.
        if self.by_run and not any(a in data.tobytes().lower() for a in self.added):
            return coded_by_run(Runs(data, offsets), self.memo, self.dtype, self.end)
        coded = [b + self.end for b in self.pack_all([t or "" for t in column.to_pylist()])]
        return np.frombuffer(b"".join(coded), self.dtype), np.array([len(b) for b in coded], np.int64) // len(self.end)


@lru_cache(maxsize=2)
def coder(path: str, end_id: int) -> Coder:
    """One coder per Python worker."""
    return Coder(path, end_id)


def fill_classes(rest: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(members, class of each sequence, filler): members in sequences of as many as the class says, and what is filler."""
    kind = np.where(rest > 0, capacity // np.maximum(rest, 1), 0)
    members, classes, filler = [], [], [np.flatnonzero((rest > 0) & (kind >= CLASSES))]
    for k in range(1, CLASSES):
        own = np.flatnonzero(kind == k)
        full = len(own) // k
        members.append(own[:full * k])
        classes.append(np.full(full, k))
        filler.append(own[full * k:])
    return np.concatenate(members), np.concatenate(classes), np.concatenate(filler)


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Pieces (document, start, length, sequence, offset) of documents of such lengths, ordered by sequence and offset."""
    lengths = np.asarray(lengths, np.int64)
    whole, rest = np.divmod(lengths, capacity)
    # Whole sequences.
    doc = np.repeat(np.arange(len(lengths)), whole)
    start = (np.arange(len(doc)) - np.repeat(within(whole)[:-1], whole)) * capacity
    parts = [np.column_stack([doc, start, np.full(len(doc), capacity), np.arange(len(doc)), np.zeros(len(doc), np.int64)])]
    sequences = len(doc)

    members, classes, filler = fill_classes(rest, capacity)
    edges = within(classes)
    filled = np.add.reduceat(rest[members], edges[:-1]) if len(classes) else np.zeros(0, np.int64)
    gaps = capacity - filled
    # Take apart the sequences with the widest gaps, until there is filler for the others.
    order = np.argsort(-gaps, kind="stable")
    stock = rest[filler].sum() + within(filled[order])
    taken = int(np.argmax(stock >= gaps.sum() - within(gaps[order])))
    apart = np.zeros(len(classes), bool)
    apart[order[:taken]] = True
    filler = np.concatenate([filler, members[np.repeat(apart, classes)]])
    members, classes, filled, gaps = members[~np.repeat(apart, classes)], classes[~apart], filled[~apart], gaps[~apart]

    own = np.repeat(np.arange(len(classes)), classes)
    offset = within(rest[members])[:-1] - within(filled)[:-1][own]
    parts.append(np.column_stack([members, whole[members] * capacity, rest[members], sequences + own, offset]))

    # Room for the filler: the gaps, then sequences of its own, the last ones of powers of two.
    left = int(rest[filler].sum() - gaps.sum())
    tail = [1 << b for b in reversed(range(capacity.bit_length())) if left % capacity >> b & 1]
    open_ = np.flatnonzero(gaps)
    room = np.concatenate([gaps[open_], np.full(left // capacity, capacity), np.array(tail, np.int64)]).astype(np.int64)
    fresh = len(room) - len(open_)
    room_sequence = np.concatenate([sequences + open_, sequences + len(classes) + np.arange(fresh)])
    room_offset = np.concatenate([filled[open_], np.zeros(fresh, np.int64)])
    source, target = within(rest[filler]), within(room)
    cuts = np.union1d(source, target)
    size = np.diff(cuts)
    i = np.searchsorted(source, cuts[:-1], side="right") - 1
    j = np.searchsorted(target, cuts[:-1], side="right") - 1
    parts.append(np.column_stack([filler[i], whole[filler[i]] * capacity + cuts[:-1] - source[i], size, room_sequence[j],
                                  room_offset[j] + cuts[:-1] - target[j]]))
    pieces = np.concatenate(parts).astype(np.int64)
    return pieces[np.lexsort((pieces[:, 4], pieces[:, 3]))]


def packed(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, block_ids: int = BLOCK_IDS, batch_ids: int = BATCH_IDS) -> DataFrame:
    """doc_id, start, length, ids (unsigned little-endian 32-bit integers), doc_tokens, sequence_id, offset of every piece.

    Pieces with the same sequence_id, joined in the order of their offsets, are a sequence.
    """
    kind = docs.schema["doc_id"].dataType

    def emit(ids: pa.ChunkedArray, flat: np.ndarray, lengths: np.ndarray, number: int):
        """The pieces of a block of documents in batches of bounded size."""
        base, plan = within(lengths), pack(lengths, capacity)
        low, seen = 0, within(plan[:, 2])
        while low < len(plan):
            high = max(low + 1, int(np.searchsorted(seen, seen[low] + batch_ids, side="right")) - 1)
            doc, start, length, sequence, offset = plan[low:high].T
            data = gathered(flat, base[doc] + start, length).astype("<u4")
            binary = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer((within(length) * 4).astype(np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(doc)).combine_chunks(), pa.array(start), pa.array(length), binary, pa.array(lengths[doc]), pa.array(number + sequence), pa.array(offset)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            low = high

    def run(batches):
        code, number, held = coder(tokenizer, end_id), TaskContext.get().partitionId() << 33, []

        def flush():
            nonlocal number
            parts, flat, lengths = zip(*held)
            for out in emit(pa.chunked_array(parts), np.concatenate(flat), np.concatenate(lengths), number):
                last = out.column(5)[-1].as_py()
                yield out
            number = last + 1
            held.clear()

        for batch in batches:
            for part in pieces(batch, limit=PIECE_BYTES):
                held.append((part.column(0), *code.ids(part.column(1))))
                if sum(len(flat) for _, flat, _ in held) >= block_ids:
                    yield from flush()
        if held:
            yield from flush()

    return map_arrow(texts(docs), run, f"doc_id {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids of every sequence. The pieces of one are at most as many as the capacity has places."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda joined, part: F.concat(joined, part["ids"])).alias("ids"))
