"""Fixity audit of WARC replicas with Merkle trees.

A collection is a folder of .warc.gz files, one gzip member per record, and an index of its records: file, place in the
file, offset, length. Replicas hold the same files. An audit hashes every record of a replica at its indexed range (a leaf),
then FANOUT neighbours at a time into nodes that cover longer and longer ranges of offsets, up to one root per file and
from there to one root per replica. Two replicas are compared from the root down: only the children of nodes that
differ are looked at, so the joins below the top are as large as the damage, and the leaves that differ are the corrupt records.

Defined cases: a file that is missing or too short in a replica counts as corrupt from there on, even if it is so in both; bytes behind the
last record belong to it; null html is an empty
payload, null url an empty address; repeated pages are records of their own; an empty table makes an empty collection.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import map_arrow, stored
from tidegate.llm.tokenfiles import place, put

FANOUT = 16
INDEX = "file string, nth long, offset long, length long, page_id {}"


def record(url: str, page, html: str) -> bytes:
    """One response record as a gzip member; equal input gives equal bytes."""
    body = html.encode("utf-8")
    mark = hashlib.sha256(f"{page}\x00{url}\x00".encode() + body).hexdigest()
    head = (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:sha256:{mark}>\r\nWARC-Target-URI: {url}\r\n"
            f"WARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n")
    return gzip.compress(head.encode("utf-8") + body + b"\r\n\r\n", 3, mtime=0)


def write_collection(pages: DataFrame, folders: list[str], damaged: Column) -> DataFrame:
    """Write pages to WARC files, the same in each folder, and return the index. In all folders but the first, one byte
    of each record that the condition names is changed: a rehearsal of decay."""
    kind = pages.schema["page_id"].dataType.simpleString()
    read = (pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), F.coalesce(damaged, F.lit(False)).alias("damaged"))
            .repartitionByRange("page_id").sortWithinPartitions("page_id", "url", "html"))

    def run(batches):
        name, rows, records = f"pages-{TaskContext.get().partitionId():06d}.warc.gz", [], []
        ids, broken, offset = [], [], 0
        for batch in batches:
            ids.append(batch.column(0))
            for page, url, html, hurt in zip(*(c.to_pylist() for c in batch.columns)):
                data = record(url, page, html)
                records.append(data)
                broken.append(hurt)
                rows.append((offset, len(data)))
                offset += len(data)
        if not rows:
            return
        put(folders[0], name, records)
        for folder in folders[1:]:
            put(folder, name, (_changed(r) if hurt else r for r, hurt in zip(records, broken)))
        n = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * n), pa.array(range(n), pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
             pa.array([r[1] for r in rows], pa.int64()), pa.chunked_array(ids).combine_chunks()],
            names=["file", "nth", "offset", "length", "page_id"])

    return stored(map_arrow(read, run, INDEX.format(kind)), "warc-index")


def _changed(data: bytes) -> bytes:
    middle = len(data) // 2
    return data[:middle] + bytes([data[middle] ^ 1]) + data[middle + 1:]


def leaves(index: DataFrame, folder: str) -> DataFrame:
    """file, nth, offset, stop, digest of every indexed record of a replica. Each task reads its records' ranges in order.

    A range that cannot be read whole has a digest of its own in every replica, so that it is never taken for equal. Bytes behind the last
    record of a file count as part of it.
    """
    def run(batches):
        held: dict[str, object] = {}
        system, root = place(folder)
        for batch in batches:
            digests = []
            for name, nth, offset, length, last in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if name not in held:
                    held.clear()
                    found = system.get_file_info(f"{root}/{name}")
                    held[name] = system.open_input_file(found.path) if found.is_file else None
                size = held[name].size() if held[name] else 0
                if offset + length > size:
                    digests.append(hashlib.sha256(f"\x02{folder}\x00{name}\x00{nth}".encode()).digest())
                    continue
                data = held[name].read_at(size - offset if nth == last else length, offset)
                digests.append(hashlib.sha256(b"\x00" + data).digest())
            stop = pa.compute.add(batch.column(2), batch.column(3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), stop, pa.array(digests, pa.binary())],
                                             names=["file", "nth", "offset", "stop", "digest"])

    ends = index.groupBy("file").agg(F.max("nth").alias("last"))
    return map_arrow(index.join(ends, "file").select("file", "nth", "offset", "length", "last"), run, "file string, nth long, offset long, stop long, digest binary")


def _parents(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """FANOUT neighbours hashed into one node, which covers their ranges."""
    children = F.array_sort(F.collect_list(F.struct("nth", F.hex("digest").alias("digest"))))
    joined = F.array_join(F.transform(children, lambda c: c["digest"]), "")
    return (nodes.groupBy(*keys, F.floor(F.col("nth") / FANOUT).alias("up"))
            .agg(F.min("offset").alias("offset"), F.max("stop").alias("stop"), F.unhex(F.sha2(F.concat(F.lit(b"\x01"), F.unhex(joined)), 256)).alias("digest"))
            .withColumnRenamed("up", "nth"))


def tree(index: DataFrame, folder: str, heights: tuple[int, int]) -> list[DataFrame]:
    """Levels of a replica's tree from the leaves up: so many levels within files, then so many over the files' roots."""
    levels = [stored(leaves(index, folder), "leaves")]
    for _ in range(heights[0]):
        levels.append(_parents(levels[-1], ["file"]))
    files = index.select("file").distinct()
    numbered = stored(files.withColumn("at", F.regexp_extract("file", r"(\d+)\.warc", 1).cast("long")), "warc-files")
    roots = levels[-1].join(numbered, "file").select(F.lit("").alias("file"), F.col("at").alias("nth"), "offset", "stop", "digest")
    levels.append(roots)
    for _ in range(heights[1]):
        levels.append(_parents(levels[-1], ["file"]))
    # The nodes above the leaves are a fifteenth of them; each level is kept, so a descent reads and does not rebuild.
    return levels[:1] + [stored(level, "nodes") for level in levels[1:]]


def heights_of(index: DataFrame) -> tuple[int, int]:
    found = index.agg(F.max("nth"), F.max(F.regexp_extract("file", r"(\d+)\.warc", 1).cast("long"))).first()

    def height(last: int | None) -> int:
        n = 0
        while last:
            last //= FANOUT
            n += 1
        return n
    return height(found[0]), height(found[1])


def audit(index: DataFrame, replica_a: str, replica_b: str) -> DataFrame:
    """file, nth, offset, length, digest_a, digest_b of the records in which two replicas differ."""
    heights = heights_of(index)
    a, b = tree(index, replica_a, heights), tree(index, replica_b, heights)
    differ = None
    for level in reversed(range(len(a))):
        left, right = a[level], b[level]
        if differ is not None and level == heights[0]:
            # From the tree over the files to the roots of the files themselves.
            names = F.concat(F.lit("pages-"), F.lpad(F.col("nth").cast("string"), 6, "0"), F.lit(".warc.gz"))
            below = differ.select(names.alias("file"), F.lit(0).cast("long").alias("nth"))
            left, right = (x.join(below, ["file", "nth"], "left_semi") for x in (left, right))
        elif differ is not None:
            below = differ.select("file", F.col("nth").alias("up"))
            left, right = (x.withColumn("up", F.floor(F.col("nth") / FANOUT)).join(below, ["file", "up"], "left_semi").drop("up") for x in (left, right))
        pair = left.join(right.select("file", "nth", F.col("digest").alias("other")), ["file", "nth"]).where("digest != other")
        if level == 0:
            return pair.select("file", "nth", "offset", (F.col("stop") - F.col("offset")).alias("length"),
                               F.lower(F.hex("digest")).alias("digest_a"), F.lower(F.hex("other")).alias("digest_b"))
        differ = stored(pair.select("file", "nth"), "differ")
        if differ.isEmpty():
            return a[0].limit(0).select("file", "nth", "offset", F.lit(0).cast("long").alias("length"), F.lit("").alias("digest_a"), F.lit("").alias("digest_b"))
