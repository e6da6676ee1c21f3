"""What belongs to stored tables: a ledger with one row per load.

A load writes to folders of its own, ``_load=<id>`` below each of its tables, and then appends one row to the ledger. That
row makes history, state and the list of loaded files visible together; what a failed load has written is never read, and
writing the same again adds nothing. A row says for each table which columns it has from then on and which folders it
gains (``more``) or consists of. One writer per ledger at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD = "_load"
ROWS = ("version long, load_id string, committed_at timestamp, "
        "tables map<string, struct<columns: string, parts: array<string>, more: boolean>>")
# What tells a file from another of the same name.
IDENTITY = "_file string, length long, modified timestamp"


def is_absent(error: AnalysisException) -> bool:
    """Nothing has been written to the path yet."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def ledger_path(table: str) -> str:
    """History and state of one table share a ledger beside them."""
    return re.sub(r"_(all|last)$", "", table.rstrip("/")) + "_ledger"


def load_folder(load_id: str) -> str:
    return f"{LOAD}={load_id}"


def new_load() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True)
class Change:
    """What a load does to a table: its columns from then on, and folders that are added to it or that replace it."""

    columns: T.StructType
    parts: Sequence[str]
    more: bool = False


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        return self._read(f"{self.path}/loads", ROWS)

    def _read(self, path: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if not is_absent(error):
                raise
            return self.spark.createDataFrame([], schema)

    def version(self) -> int:
        return self.rows().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def content(self, table: str) -> tuple[T.StructType, list[str]] | None:
        """Columns and live folders of a table; None before its first load.

        The driver gets one path per live folder: loads for a history, days for a state.
        """
        own = self.rows().select("version", F.col("tables")[table].alias("t")).where("t IS NOT NULL").select("version", "t.*")
        seen = own.agg(F.max_by("columns", "version").alias("columns"), F.max(F.when(~F.col("more"), F.col("version"))).alias("base")).first()
        if seen["columns"] is None:
            return None
        live = own.where(F.col("version") >= (seen["base"] or 0)).select("version", F.explode("parts").alias("part"))
        return T.StructType.fromJson(json.loads(seen["columns"])), [r["part"] for r in sorted(live.collect())]

    def loaded_files(self) -> DataFrame:
        """Identity of every file that a load of the ledger has taken."""
        files = self._read(f"{self.path}/files", f"{IDENTITY}, {LOAD} string")
        done = self.rows().select(F.col("load_id").alias(LOAD))
        return files.join(F.broadcast(done), LOAD, "left_semi").drop(LOAD)

    def note_files(self, files: DataFrame, load_id: str) -> None:
        """Set down the files of a load; they count once the load is committed."""
        files.write.mode("overwrite").parquet(f"{self.path}/files/{load_folder(load_id)}")

    def commit(self, load_id: str, changes: Mapping[str, Change]) -> int:
        """Make a load visible. The row is one file, put in place by one rename."""
        version = self.version() + 1
        tables = {name: (c.columns.json(), list(c.parts), c.more) for name, c in changes.items()}
        row = self.spark.createDataFrame([(version, load_id, datetime.now(), tables)], ROWS)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/loads")
        return version
