"""Token ids as flat binary files.

A corpus is a folder of shards in ascending order of document id. A shard has
  ids-N.bin      unsigned little-endian integers, two bytes each where the vocabulary allows it, else four
  offsets-N.bin  unsigned 64-bit integers: where each document begins in the whole corpus, and where the last one ends
  docs-N.arrow   the ids of its documents
and manifest.json names the width, the shards and their bases. Documents are dealt to shards by ranges of their id and
sorted there. A task encodes its shard and writes ids and lengths; the bases are the prefix sums of the shards' totals
(one number per shard), with which a second, small job writes the offsets. Files are written under a name of their
own and then renamed, so a task that is run again, even at the same time, does no harm. Readers map the files.

Encoding is the tokenizers library's. A byte-level model with the usual word pattern never joins what lies on both sides
of the border between a visible character and a blank, so every distinct run of characters of a piece of texts is encoded once,
and what it gave is remembered (a bounded memo). Texts with other white space, or with the text of an added token, are encoded as a whole.

Defined cases: null is an empty text; an empty text has only the end id; null document ids come first; equal ids stand
together, ordered by text; an empty table makes a corpus without shards.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from array import array
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.frames import arrow_batch, map_arrow, texts
from tidegate.llm.words import Memo, Words, buffers, byte_table, coded_by_run, gathered, pieces, within
from tidegate.session import fresh_path

# A run begins with the blanks before a word, or with punctuation after a letter.
BLANK = byte_table(b" \n")
LETTER = byte_table([*range(0x41, 0x5B), *range(0x61, 0x7B)])
POINT = byte_table(b".,!?;:|")
# White space of any kind but the blank and the line feed.
OTHER_BLANKS = [c for c in map(chr, range(0x10000)) if c.isspace() and c not in " \n"]
READ_ROWS, PIECE_BYTES, MEMO_RUNS = 4096, 4 << 20, 500_000


class Runs(Words):
    """Runs of characters that are encoded independently; together they are the texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside, begins = ~BLANK[data], np.zeros(len(data), bool)
        begins[1:] = (inside[:-1] & ~inside[1:]) | (LETTER[data[:-1]] & POINT[data[1:]])
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        self.data, self.start = data, np.flatnonzero(begins)
        self.end = np.append(self.start[1:], len(data)) if len(self.start) else self.start
        self.first = np.searchsorted(self.start, offsets)


class Encoder:
    """Ids of texts, each followed by the end id, as unsigned integers."""

    def __init__(self, path: str, end_id: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = "<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        self.kind = "H" if self.dtype == "<u2" else "I"
        self.end = array(self.kind, [end_id]).tobytes()
        rules = json.loads(self.tokenizer.to_str())
        before = rules.get("pre_tokenizer") or {}
        self.by_run = (rules.get("normalizer") is None and before.get("type") == "ByteLevel"
                       and before.get("use_regex") and not before.get("add_prefix_space"))
        # Texts with any of these are encoded as a whole.
        self.whole = [w.encode() for w in (*OTHER_BLANKS, *(t.content for t in self.tokenizer.get_added_tokens_decoder().values()))]
        self.memo = Memo(self.pack_all, MEMO_RUNS)

    def pack_all(self, runs: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)
        return [array(self.kind, e.ids).tobytes() for e in coded]

    def odd_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts have to be encoded as a whole."""
        odd = np.full(len(offsets) - 1, not self.by_run)
        raw = data.tobytes() if self.by_run else b""
        for mark in self.whole:
            at = raw.find(mark)
            while at >= 0:
                i = int(np.searchsorted(offsets, at, side="right")) - 1
                odd[i] = True
                at = raw.find(mark, int(offsets[i + 1]))
        return odd

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column, one after another, and how many each text has; null counts as empty."""
        odd = self.odd_texts(*buffers(column))
        plain, counts = coded_by_run(Runs(*buffers(column.filter(pa.array(~odd)))), self.memo, self.dtype, self.end)
        if not odd.any():
            return plain, counts
        coded = [b + self.end for b in self.pack_all([t or "" for t in column.filter(pa.array(odd)).to_pylist()])]
        sizes = np.empty(len(odd), np.int64)
        sizes[~odd], sizes[odd] = counts, [len(b) // len(self.end) for b in coded]
        start = np.empty(len(odd), np.int64)
        start[~odd], start[odd] = within(counts)[:-1], len(plain) + within(sizes[odd])[:-1]
        return gathered(np.concatenate([plain, np.frombuffer(b"".join(coded), self.dtype)]), start, sizes), sizes


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path, end_id)


def place(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def put(folder: str, name: str, chunks) -> None:
    """Write a file under a name of its own, then give it its real name."""
    system, root = place(folder)
    system.create_dir(root, recursive=True)
    own = f"{root}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        for chunk in chunks:
            out.write(chunk)
    system.move(own, f"{root}/{name}")


def get(folder: str, name: str) -> pa.Buffer:
    """A file's bytes, mapped where the file system allows it."""
    system, root = place(folder)
    path = f"{root}/{name}"
    if isinstance(system, pyarrow.fs.LocalFileSystem):
        with pa.memory_map(path) as file:
            return file.read_buffer()
    with system.open_input_file(path) as file:
        return file.read_buffer()


def write(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> dict:
    """Encode all documents, add the end id to each, write the files; returns the manifest."""
    spark = docs.sparkSession

    def encode(batches):
        coder, shard = encoder(tokenizer, end_id), TaskContext.get().partitionId()
        counts, ids = [], []

        def packed():
            for batch in batches:
                for part in pieces(batch, limit=PIECE_BYTES):
                    flat, sizes = coder.ids(part.column(1))
                    ids.append(part.column(0))
                    counts.append(sizes)
                    yield flat.tobytes()

        first = next(stream := packed(), None)
        if first is None:
            return
        put(folder, f"ids-{shard:06d}.bin", chain([first], stream))
        lengths = np.concatenate(counts)
        put(folder, f"lengths-{shard:06d}.bin", [lengths.astype("<u8").tobytes()])
        table = pa.table({"doc_id": pa.chunked_array(ids)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, table.schema) as out:
            out.write_table(table)
        put(folder, f"docs-{shard:06d}.arrow", [sink.getvalue()])
        yield arrow_batch(shard=pa.array([shard], pa.int64()), docs=pa.array([len(lengths)], pa.int64()), ids=pa.array([int(lengths.sum())], pa.int64()))

    # Rows that share an id are told apart by the beginning of their text, so that they need not be one task's.
    ordered = texts(docs).repartitionByRange(F.col("doc_id"), F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
    # One row per shard comes to the driver.
    shards = sorted(map(tuple, map_arrow(ordered, encode, "shard long, docs long, ids long").collect()))
    bases = [0, *accumulate(ids for _, _, ids in shards)]

    def finish(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                shard = shards[i][0]
                lengths = np.frombuffer(get(folder, f"lengths-{shard:06d}.bin"), "<u8")
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8") + np.uint64(bases[i])
                put(folder, f"offsets-{shard:06d}.bin", [offsets.astype("<u8").tobytes()])
            yield batch

    if shards:
        map_arrow(spark.range(0, len(shards), 1, len(shards)), finish, "id long").write.format("noop").mode("overwrite").save()
    manifest = {"width": Encoder(tokenizer, end_id).dtype, "end_id": end_id, "total": bases[-1],
                "shards": [{"shard": s, "docs": d, "ids": n, "base": b} for (s, d, n), b in zip(shards, bases)]}
    put(folder, "manifest.json", [json.dumps(manifest).encode()])
    return manifest


def read(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; one task per shard."""
    manifest = json.loads(get(folder, "manifest.json").to_pybytes())
    shards, width = manifest["shards"], manifest["width"]
    schema = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long"
    if not shards:
        return spark.createDataFrame([], schema)

    def run(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                shard, base = shards[i]["shard"], shards[i]["base"]
                ids = np.frombuffer(get(folder, f"ids-{shard:06d}.bin"), width)
                offsets = np.frombuffer(get(folder, f"offsets-{shard:06d}.bin"), "<u8").astype(np.int64)
                docs = pa.ipc.open_file(pa.BufferReader(get(folder, f"docs-{shard:06d}.arrow"))).read_all().column(0).combine_chunks()
                for low in range(0, len(docs), READ_ROWS):
                    part = offsets[low:low + READ_ROWS + 1]
                    sums = [zlib.crc32(ids[a - base:b - base].astype("<u4").tobytes()) for a, b in zip(part, part[1:])]
                    yield arrow_batch(doc_id=docs.slice(low, READ_ROWS), start=pa.array(part[:-1]), n_tokens=pa.array(np.diff(part)),
                                      ids_crc32=pa.array(sums, pa.int64()))

    return map_arrow(spark.range(0, len(shards), 1, len(shards)), run, schema)


def tokens(spark: SparkSession, folder: str, doc: int) -> np.ndarray:
    """Ids of the document at a place (0 is the first), by two lookups in mapped files."""
    manifest = json.loads(get(folder, "manifest.json").to_pybytes())
    for entry in manifest["shards"]:
        if doc < entry["docs"]:
            name = f"{entry['shard']:06d}.bin"
            a, b = np.frombuffer(get(folder, f"offsets-{name}"), "<u8")[doc:doc + 2].astype(np.int64) - entry["base"]
            return np.frombuffer(get(folder, f"ids-{name}"), manifest["width"])[a:b]
        doc -= entry["docs"]
    raise IndexError(doc)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write a corpus to the shared folder and read it back."""
    folder = fresh_path(docs.sparkSession, "tokens")
    write(docs, tokenizer, end_id, folder)
    return read(docs.sparkSession, folder, docs.schema["doc_id"].dataType.simpleString())
