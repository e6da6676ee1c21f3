"""From raw documents to documents fit for training, stage by stage.

Every stage reads what its predecessor kept and returns the columns of documents; the last adds what encoding gives.
Texts that a stage changes get a new n_chars. Near duplicates and decontamination decide rows that share a doc_id together, the other
stages row by row. A stage's result has to
be written before the next stage is called, which first deletes the tables its predecessor worked with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import contamination, neardup, pieces, quality, substrings
from tidegate.llm.frames import release
from tidegate.llm.queries import tokenizer_path
from tidegate.session import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Percent of shared word shingles from which documents are near-duplicates, and the minhash collections that takes.
NEAR, NEAR_GROUPS = 80, 16
BATCH_ROWS = 1000
# SQL cannot express the trained classifier; tests compare the stages with brute force.
ORACLE_SQL = None


def begin(spark: SparkSession, last: bool = False) -> None:
    """Before a stage: delete what the one before worked with, and keep Arrow batches small, since executors hold a few of them beside
    the sorts of the shuffles."""
    release(spark, last)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier, trained on the labels outside the held-out part, finds likelier to be poor."""
    begin(spark)
    scored = quality.quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=COLUMNS)
    return scored.where("predicted = 1").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of each group of near-duplicates (a Jaccard similarity of 0.80 or more). Texts without
    words stay."""
    begin(spark)
    dropped = neardup.near_duplicates(docs, NEAR, NEAR_GROUPS).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out passages of 50 words or more that also stand in an earlier document. Untouched texts keep their white
    space; documents of which nothing is left go."""
    begin(spark)
    cut = substrings.deduplicated(docs, keep=COLUMNS)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return (cut.where("n_removed = 0 OR n_removed < n_words")
            .select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("n_removed") > 0, F.length("kept").cast("long"))
                    .otherwise(F.col("n_chars")).alias("n_chars")))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a 10-word window of a benchmark item."""
    begin(spark)
    found = contamination.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    dropped = found.where("contaminated").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and proof that they decode to it."""
    begin(spark, last=True)
    return pieces.encode_decode(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("substrings", substring_stage),
          ("decontamination", decontamination_stage), ("encoding", encoding_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another, each stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
