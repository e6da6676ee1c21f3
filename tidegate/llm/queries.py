"""Queries of the operators of this package, with SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import contamination, lm, manifest, neardup, packing, pieces, quality, runs, substrings, tokenfiles, unigram, vectors, warc
from tidegate.session import fresh_path


def tokenizer_path(name: str) -> str:
    """Vocabulary files lie in the folder TOKENIZERS names, or in the installed package."""
    folder = os.environ.get("TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


# Pages whose record decays in the second replica of op2.
DECAY = "page_id % 37 = 5"


def op2_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    """Two replicas of the pages as WARC files, some records of the second damaged; one row per record: is it corrupt?"""
    folders = [fresh_path(spark, "replica") for _ in range(2)]
    index = warc.write_collection(table(spark, folder, "pages"), folders, F.expr(DECAY))
    found = warc.audit(index, *folders).select("file", "nth", F.lit(True).alias("found"))
    return index.join(found, ["file", "nth"], "left").select("page_id", F.coalesce("found", F.lit(False)).alias("corrupt"))


OP2_SQL = f"SELECT page_id, coalesce({DECAY}, false) AS corrupt FROM pages"


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_embedding_pq(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


# Longest n-grams of op6.
LM_ORDER = 3


def op6_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scores(table(spark, folder, "documents"), LM_ORDER)


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_decode(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenfiles.round_trip(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.deduplicated(table(spark, folder, "documents"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return unigram.token_counts(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op11_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces_ = packing.packed(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)
    return pieces_.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(runs.planted(table(spark, folder, "documents")), exponent=4, least=6))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.proofs(table(spark, folder, "documents"))


def counted(column: str) -> str:
    """SQL for one column of a leaf: the number of its bytes and its text, or a dash."""
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE concat(strlen({column}), ':', {column}) END"


# Trees level by level, then every leaf folded upwards along its siblings. Level numbers of the tree over the sources go on from 100.
OP13_SQL = f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, lang, n_chars, text, CASE WHEN list_reduce(
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda crc, b: list_reduce(range(8), lambda r, i: xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384 ELSE 0 END), xor(crc, b)),
      CAST(4294967295 AS BIGINT)) & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS altered
  FROM documents),
leaves AS (
  SELECT doc_id, source, sha256(concat(head, {counted("text")})) AS leaf, sha256(concat(head, {counted("altered")})) AS changed
  FROM (SELECT *, concat({counted("CAST(doc_id AS VARCHAR)")}, {counted("source")}, {counted("lang")}, {counted("CAST(n_chars AS VARCHAR)")}) AS head FROM rows_)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
low AS (
  SELECT source, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM numbered
  UNION ALL
  SELECT source, any_value(level) + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value(n + 2) // 3
  FROM low WHERE n > 1 GROUP BY source, pos // 3),
subroots AS (SELECT source, level AS top, digest, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos FROM low WHERE n = 1),
high AS (
  SELECT 100 AS level, pos, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value(n + 2) // 3 FROM high WHERE n > 1 GROUP BY pos // 3),
root AS (SELECT level AS summit, digest FROM high WHERE n = 1),
nodes AS (SELECT source, level, pos, digest FROM low UNION ALL SELECT NULL, level, pos, digest FROM high),
beside AS (
  SELECT a.source, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS left_,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS right_
  FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // 3 = b.pos // 3 AND (a.level >= 100) = (b.level >= 100)
  GROUP BY a.source, a.level, a.pos),
walk AS (
  SELECT n.doc_id, n.leaf, n.changed AS node, n.source, 0 AS level, n.pos, s.top, s.pos AS place, s.digest AS subroot, '' AS proof
  FROM numbered n JOIN subroots s ON n.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT w.doc_id, w.leaf, CASE WHEN w.level = w.top THEN w.node ELSE sha256(concat(b.left_, w.node, b.right_)) END, w.source,
         CASE WHEN w.level = w.top THEN 100 ELSE w.level + 1 END, CASE WHEN w.level = w.top THEN w.place ELSE w.pos // 3 END, w.top, w.place, w.subroot,
         CASE WHEN w.level = w.top THEN w.proof ELSE concat(w.proof, b.left_, b.right_) END
  FROM walk w JOIN root r ON w.level < r.summit
  JOIN beside b ON b.level = w.level AND b.pos = w.pos AND b.source IS NOT DISTINCT FROM (CASE WHEN w.level >= 100 THEN NULL ELSE w.source END))
SELECT w.doc_id, w.leaf, w.subroot, r.digest AS root, sha256(w.proof) AS proof_sha256, w.node AS folded_root, w.node = r.digest AS verified
FROM walk w JOIN root r ON w.level = r.summit
"""


def queries() -> dict:
    return {name: fn for name, fn in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_fixity": OP2_SQL, "op13_merkle_manifest": OP13_SQL}
