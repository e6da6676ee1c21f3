"""History tables and current-state tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.files import stem
from tidegate.operators.modes import PROCESS_DATE, no_null
from tidegate.operators.shape import column, dedup_columns, move_first
from tidegate.session import broadcast_if_small
from tidegate.sinks.ledger import LOAD, Change, Ledger, is_absent, ledger_path, load_folder, new_load
from tidegate.sinks.schema import evolved

# Technical columns of every stored table.
FILE_NAME = "FILE_NAME_RECEIVED"
PARTITIONS = ("yyyy", "mm", "dd")


def output_path(root: str, env: str, zone: str, version: str, table: str) -> str:
    return f"{root.rstrip('/')}/{env}/{zone}/{version}/{table}"


def stamp(df: DataFrame, parts: Mapping[str, Column | int | None] | None = None,
          filename: Column | str | None = None, processed: datetime | Column | None = None,
          partition_types: Mapping[str, str] | None = None) -> DataFrame:
    """Audit columns first, partition columns last, no two columns with the same name.

    ``filename`` is a path, or a column that already holds the name without folder and extension.
    Date parts a file name lacks come from the processing date, a missing day is the first.
    """
    at = F.current_timestamp() if processed is None else processed
    at = at if isinstance(at, Column) else F.lit(at)
    given = {k: v if isinstance(v, Column) else F.lit(v).cast("int") for k, v in (parts or {}).items()}
    today = {"yyyy": F.year(at), "mm": F.month(at), "dd": F.dayofmonth(at)}
    year = given.get("yyyy", F.lit(None).cast("int"))
    values = {
        "yyyy": F.coalesce(year, today["yyyy"]),
        "mm": F.when(year.isNull(), today["mm"]).otherwise(F.coalesce(given.get("mm", F.lit(None)), F.lit(1))),
        "dd": F.when(year.isNull(), today["dd"]).otherwise(F.coalesce(given.get("dd", F.lit(None)), F.lit(1))),
    }
    audit = {PROCESS_DATE: at.cast("timestamp")}
    if filename is not None:
        audit[FILE_NAME] = filename if isinstance(filename, Column) else stem(F.lit(filename))
    kinds = partition_types or {}
    stamped = dedup_columns(df).withColumns(
        audit | {k: v.cast(kinds.get(k, "int")) for k, v in values.items()})
    return move_first(stamped, (FILE_NAME, PROCESS_DATE))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge: bool = True) -> DataFrame | None:
    """A stored table, or None when there is none: what its ledger lists, or all files of a folder without a ledger.

    A ledger knows the columns. Without one the union takes the footer of every file; who needs the partition columns
    only does without it.
    """
    stored = StoredTable(spark, path, fmt).read()
    if stored is not None:
        return stored
    try:
        return spark.read.format(fmt).option("mergeSchema", merge).load(path)
    except AnalysisException as error:
        if is_absent(error):
            return None
        raise


def partition_types(existing: DataFrame | T.StructType | None) -> dict[str, str]:
    """Types the partition columns already have, so that appended rows agree with them."""
    if existing is None:
        return {}
    columns = existing.schema if isinstance(existing, DataFrame) else existing
    return {f.name: f.dataType.simpleString() for f in columns.fields if f.name in PARTITIONS}


def write_partitioned(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    df.write.format(fmt).option("mergeSchema", True).mode(mode).partitionBy(*PARTITIONS).save(path)


def balanced(df: DataFrame) -> DataFrame:
    """Rows grouped by partition value before a write, large partitions split and small ones joined by AQE."""
    return df.hint("rebalance", *[F.col(p) for p in PARTITIONS])


class StoredTable:
    """A table made of the folders its ledger lists."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self.name, self.ledger = self.path.rsplit("/", 1)[-1], Ledger(spark, ledger_path(self.path))
        self._held = None

    def held(self) -> StoredTable:
        """The table as it is now, whatever is committed from here on; its content is looked up once."""
        fixed = type(self)(self.spark, self.path, self.fmt)
        fixed._held = (self.content(),)
        return fixed

    def content(self) -> tuple[T.StructType, list[str]] | None:
        return self._held[0] if self._held else self.ledger.content(self.name)

    def columns(self) -> T.StructType | None:
        found = self.content()
        return found[0] if found else None

    def accepts(self, batch: T.StructType) -> T.StructType:
        """The table's columns with those of a batch; raises TypeConflict when they do not go together."""
        return evolved(self.columns(), batch, PARTITIONS)

    def read(self, parts: Sequence[str] | None = None, columns: T.StructType | None = None) -> DataFrame | None:
        """The committed rows, of some folders and under other columns if asked for; no footer is read for the columns."""
        found = self.content()
        if found is None:
            return None
        columns, parts = columns or found[0], found[1] if parts is None else parts
        if not parts:
            return self.spark.createDataFrame([], columns)
        reader = self.spark.read.format(self.fmt).schema(T.StructType([*columns.fields, T.StructField(LOAD, T.StringType())]))
        return reader.option("basePath", self.path).load([f"{self.path}/{p}" for p in parts]).select([column(c) for c in columns.names])

    def put(self, df: DataFrame, load_id: str) -> str:
        """Write rows to the folder of a load. They are not part of the table before the load is committed."""
        part = load_folder(load_id)
        write_partitioned(df, f"{self.path}/{part}", "overwrite", self.fmt)
        return part

    def days_of(self, part: str, columns: T.StructType) -> list[str]:
        """Folders of the days below a folder."""
        fields = [f for f in columns.fields if f.name in PARTITIONS]
        try:
            found = self.spark.read.format(self.fmt).schema(T.StructType(fields)).load(f"{self.path}/{part}").distinct().collect()
        except AnalysisException as error:
            if not is_absent(error):
                raise
            return []
        return sorted("/".join([part, *(f"{p}={row[p]}" for p in PARTITIONS)]) for row in found)


class CurrentTable(StoredTable):
    """Current state of a table, by days.

    Readers see the old state until the new one is complete, a state can be computed from itself, and a new state keeps the
    folders of the days it does not touch.
    """

    def latest(self) -> tuple[int, list[str] | None]:
        found = self.content()
        return (self.ledger.version(), found[1]) if found else (0, None)

    def touched(self, keys: Sequence[str], batch: DataFrame, key_bytes: int | None = None) -> list[str]:
        """Folders that hold a key of the batch. Only keys and days of the table are read."""
        found = self.content()
        stored = self.read()
        if stored is None or not found[1]:
            return []
        wanted = broadcast_if_small(batch.filter(no_null(keys)).select([column(k) for k in keys]).distinct(), key_bytes)
        folder = F.regexp_extract(F.col("_metadata.file_path"), f"({LOAD}=[^/]+(?:/[^/]+)*)/[^/]+$", 1)
        columns, parts = found
        reader = self.spark.read.format(self.fmt).schema(columns).option("basePath", self.path)
        here = reader.load([f"{self.path}/{p}" for p in parts]).select(*[column(k) for k in keys], folder.alias("_part"))
        return sorted(r[0] for r in here.join(wanted, list(keys), "left_semi").select("_part").distinct().collect())

    def change(self, df: DataFrame, load_id: str, columns: T.StructType | None = None, kept: Sequence[str] | None = None) -> Change:
        """Write rows; they are to become the state, beside the folders to be kept, or to be added to it (``kept`` is None)."""
        columns = columns or self.accepts(df.schema)
        days = self.days_of(self.put(df, load_id), columns)
        return Change(columns, days, True) if kept is None else Change(columns, [*kept, *days])

    def replace(self, state: DataFrame, kept: Sequence[str] = ()) -> str:
        """Make rows the state, beside the days to be kept."""
        load_id = new_load()
        columns = self.accepts(state.schema) if kept else evolved(None, state.schema)
        self.ledger.commit(load_id, {self.name: self.change(state, load_id, columns, kept)})
        return self.path

    def append(self, batch: DataFrame) -> str:
        load_id = new_load()
        self.ledger.commit(load_id, {self.name: self.change(batch, load_id)})
        return self.path


def without(df: DataFrame, *names: str) -> DataFrame:
    return df.select([column(c) for c in df.columns if c not in names])
