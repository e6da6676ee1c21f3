"""A governed load: files of a table to history, current state and logs.

All files of a table go through the same few jobs together; what differs per file (tolerances, verdicts,
log rows) is an aggregation by file.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.files import INVALID_NAME_DATE, base_name, decoded, has_date, name_error, name_glob, name_parts, stem
from tidegate.functions.settings import delimiter, header_mode, tolerance_column
from tidegate.operators.actions import (aborted, action_counts, action_summary, flagged_columns, invalid_columns,
                                        rejected, required, row_limit)
from tidegate.operators.cleanse import ERRORS, NULL_VALUE, cleanse, entry, error_lines, no_errors
from tidegate.operators.modes import NEEDS_KEYS, PROCESS_DATE, append, apply_mode, mode_action
from tidegate.operators.quality import check_profile, column_profile, duplicate_keys
from tidegate.operators.shape import column, fill_columns, missing_column_errors, missing_columns
from tidegate.rules import CSV_FORMATS, FORMATS, ColumnRule, TableRule, compare_column, for_table, merge_keys, ordered
from tidegate.session import BROADCAST_LIMIT, broadcast_if_small, lasting, measured_bytes, row_bytes, scratch, sized, staged
from tidegate.sinks.catalog import register_stored
from tidegate.sinks.ledger import Change, Ledger, is_absent, ledger_path, new_load
from tidegate.sinks.logs import append_log, execution_rows, quality_rows, run_row
from tidegate.sinks.schema import evolved
from tidegate.sinks.tables import PARTITIONS, CurrentTable, StoredTable, balanced, output_path, partition_types, stamp, without
from tidegate.sources.delimited import BLOCK, CORRUPT, FILE, LINEAGE, ROW, Fresh, file_heads, judged, read_files
from tidegate.sources.discovery import empty_files, file_identity, list_files
from tidegate.sources.lines import LINE, count_splits, split_offsets, with_line_id

LOG = logging.getLogger("tidegate")

# Error code of a refused row, and how the log words why a table or a file is not loaded.
INVALID_ROW = "INVALID_ROW"
NO_FILE = "No file matched"
BAD_DELIMITER = "Delimiter error"
TOO_CORRUPT = "Too many corrupted lines (%d > %s)"


@dataclass(frozen=True)
class Layout:
    """Where a run reads and writes."""

    inbox: str
    root: str
    env: str = "dev"
    version: str = "v1"
    database: str | None = None
    fmt: str = "parquet"
    # Leave out files that an earlier load of the table has taken: same path, length and time of change.
    once: bool = False

    @property
    def execution_log(self) -> str:
        return f"{self.root}/logs/execution"

    @property
    def quality_log(self) -> str:
        return f"{self.root}/logs/quality"

    def quarantine(self, table: str) -> str:
        return f"{self.root}/logs/bad_records/{self.env}/{table}"

    def table(self, rule: TableRule, suffix: str) -> str:
        return output_path(self.root, self.env, rule.zone, self.version, f"{rule.table_name}_{suffix}")


def run(spark: SparkSession, tables: Sequence[TableRule], columns: Sequence[ColumnRule], layout: Layout,
        at: datetime | None = None) -> DataFrame:
    """Load every configured table; the execution rows of the run are appended to the log in one write.

    A table that cannot be loaded has a FAILED row and does not keep the others from being loaded.
    """
    at = at or datetime.now()
    runs = [load_table(spark, rule, for_table(columns, rule.table_name), layout, at) for rule in tables]
    logged = staged(execution_rows(reduce(append, runs), layout.env, at), "runs")
    append_log(logged, layout.execution_log, 1, layout.fmt)
    return logged


def load_table(spark: SparkSession, rule: TableRule, rules: Sequence[ColumnRule], layout: Layout,
               at: datetime, source: str | None = None) -> DataFrame:
    """One table; returns its execution rows, one per file.

    ``source`` names a folder to read whole, in place of the files of the inbox that fit the name pattern.
    Whatever goes wrong becomes a FAILED row; settings are checked before anything is read or written.
    """
    began = time.time()
    common = {"table_name": rule.table_name, "input_format": rule.input_format,
              "ingestion_mode": rule.ingestion_mode, "output_zone": rule.zone}

    def failure(message: str, filename: str = "N/A", status: str = "FAILED") -> DataFrame:
        return run_row(spark, **common, filename=filename, row_count=0, column_count=0, error_count=0,
                       error_message=message, status=status, duration=round(time.time() - began, 2))

    try:
        # The typed copy of the input and all else that was staged goes when the load is done.
        with scratch(spark):
            return lasting(_load_table(spark, rule, ordered(rules), layout, at, source, common, failure, began), "runs")
    except Exception as error:  # noqa: BLE001  the next table is loaded whatever befell this one
        LOG.exception("Table %s was not loaded", rule.table_name)
        return failure(f"{type(error).__name__}: {str(error).strip().splitlines()[0] if str(error).strip() else ''}"[:500])


def setting_error(rule: TableRule, rules: Sequence[ColumnRule]) -> str | None:
    """What is wrong with the settings of a table, if anything."""
    if rule.input_format not in FORMATS:
        return f"Unsupported format {rule.input_format}"
    try:
        delimiter(rule.delimiter)
    except ValueError as error:
        return f"{BAD_DELIMITER}: {error}"
    if mode_action(rule.ingestion_mode)[0] in NEEDS_KEYS and not merge_keys(rules):
        return f"{rule.ingestion_mode} needs merge keys"
    return None


def _load_table(spark: SparkSession, rule: TableRule, rules: Sequence[ColumnRule], layout: Layout, at: datetime,
                source: str | None, common: dict, failure, began: float) -> DataFrame:
    wrong = setting_error(rule, rules)
    if wrong:
        return failure(wrong)
    found = (source, None, base_of(source)) if source else _pick_files(spark, rule, layout.inbox)
    if isinstance(found, str):
        return failure(found)
    path, glob, name = found

    def line(filename: Column, message: Column, status: str) -> list[Column]:
        """Columns of an execution row for a file that is not loaded."""
        zeros = [F.lit(0).alias(c) for c in ("row_count", "column_count", "error_count")]
        return [*[F.lit(v).alias(k) for k, v in common.items()], filename.alias("filename"), *zeros,
                message.alias("error_message"), F.lit(status).alias("status"), F.lit(round(time.time() - began, 2)).alias("duration")]

    names = [r.column_name for r in rules]
    if not source and not rule.merge_files:
        others = list_files(spark, layout.inbox, name_glob(rule.filename_pattern)).filter(F.col("name") != name)
        aside = others.select(*line(F.col("name"), F.lit(f"Not selected, {name} comes first"), "SKIPPED"))
    else:
        aside = None
    files, fresh = staged(file_identity(spark, path, glob), "files"), None
    if layout.once:
        ledger = Ledger(spark, ledger_path(layout.table(rule, "all")))
        fresh = staged(files.join(ledger.loaded_files(), [f.name for f in files.schema], "left_anti"), "fresh")
        seen = fresh.agg(F.count("*").alias("n"), F.min("modified").alias("since")).first()
        old = files.join(fresh.select(FILE), FILE, "left_anti")
        old = old.select(*line(base_name(decoded(F.col(FILE))), F.lit("Already loaded"), "SKIPPED"))
        aside = old if aside is None else append(aside, old)
        if not seen["n"]:
            return staged(aside, "aside")
        files, fresh = fresh, Fresh(sized(fresh.select(FILE)), seen["since"])
    if rule.input_format in CSV_FORMATS and header_mode(rule.header) != "none" and (glob or source):
        raw, refused = _read_by_header(spark, rule, rules, path, glob, fresh)
        refused_name = base_name(decoded(F.col(FILE)))
        lost = refused.select(F.lit(rule.table_name).alias("table_name"), refused_name.alias("filename"), F.col(FILE).alias("uri"),
                              F.explode("lost").alias("column_name"), F.lit("MISSING_COLUMN").alias("error_type"))
        append_log(quality_rows(lost, rule.table_name, rule.zone, layout.env, at), layout.quality_log, 1, layout.fmt)
        failed = refused.select(*line(refused_name, F.col("why"), "FAILED"))
        aside = failed if aside is None else append(aside, failed)
        if raw is None:
            return aside
    else:
        try:
            raw = read_files(spark, path, rule, rules, glob, fresh=fresh)
        except ValueError as error:
            return failure(str(error), name)
        lost = missing_columns(raw, names)
        if lost and not rule.delete_columns_allowed:
            rows = missing_column_errors(raw, names, rule.table_name, name)
            append_log(quality_rows(rows, rule.table_name, rule.zone, layout.env, at), layout.quality_log, 1, layout.fmt)
            return failure(f"Missing columns {lost} in the file", name)
    raw = fill_columns(raw, names)

    load, load_id = _Load(spark, rule, rules, layout, at, raw), new_load()
    errors = load.quality_errors()
    named = errors.join(load.verdicts.select(FILE, "filename"), FILE).withColumn("uri", F.col(FILE))
    changes = load.write_tables(load_id)
    append_log(quality_rows(named, rule.table_name, rule.zone, layout.env, at), layout.quality_log, fmt=layout.fmt)
    load.write_quarantine()
    if changes:
        load.history.ledger.note_files(files.join(load.accepted.select(FILE), FILE, "left_semi"), load_id)
        # Up to here nothing of the load can be seen in its tables; this row shows all of it.
        load.history.ledger.commit(load_id, changes)
        load.register()

    counted = errors.groupBy(FILE).agg(F.count(F.lit(1)).alias("error_count"))
    runs = load.verdicts.join(counted, FILE, "left").select(
        *[F.lit(v).alias(k) for k, v in common.items()],
        "filename", F.col("_rows").alias("row_count"),
        F.lit(len(load.data)).alias("column_count"), F.coalesce("error_count", F.lit(0)).alias("error_count"),
        F.coalesce("_reason", F.coalesce("error_count", F.lit(0)).cast("string")).alias("error_message"),
        F.when(F.col("_reason").isNull(), "SUCCESS").otherwise("FAILED").alias("status"),
        F.lit(round(time.time() - began, 2)).alias("duration"))
    if not mode_action(rule.ingestion_mode)[1]:
        runs = append(runs, failure(f"Unknown ingestion mode {rule.ingestion_mode!r}, appended", name, "WARN"))
    return runs if aside is None else append(runs, aside)


def _read_by_header(spark: SparkSession, rule: TableRule, rules: Sequence[ColumnRule], path: str,
                    glob: str | None, fresh: Fresh | None = None) -> tuple[DataFrame | None, DataFrame]:
    """The files whose header fits, and (_file, why, lost) of the others.

    Headers are judged where they are. The driver learns how many columns the fitting files have, how many orders of them
    there are, and which columns there are beside the configured ones. Files of one width are read by one scan, by
    position; where their orders differ, a table of one row per file says which position holds which column.
    """
    names = [r.column_name for r in rules]
    by_name = header_mode(rule.header) == "names"
    heads = staged(judged(file_heads(spark, path, rule, glob, fresh), rule, names), "heads")
    refused, fitting = heads.filter("why IS NOT NULL").select(FILE, "why", "lost"), heads.filter("why IS NULL")
    widths = fitting.groupBy("width").agg(F.count_distinct("names").alias("orders"), F.min("names").alias("names")).orderBy("width").collect()
    alone = len(widths) == 1 and (not by_name or widths[0]["orders"] == 1) and refused.isEmpty()
    raw = None
    for found in widths:
        files = fitting.filter(F.col("width") == found["width"])
        given = [f"_c{i}" for i in range(found["width"])] if by_name else []
        part = read_files(spark, path, rule, rules, glob, given, fresh)
        if by_name and found["orders"] > 1:
            part = reordered(part, files, names)
        else:
            part = part.toDF(*found["names"], *part.columns[found["width"]:]) if by_name else part
            part = part if alone else part.join(sized(files.select(FILE)), FILE, "left_semi")
        raw = part if raw is None else raw.unionByName(part, allowMissingColumns=True)
    return raw, refused


def reordered(part: DataFrame, files: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns by name out of rows read by position, for files with the same columns in different orders."""
    known = {n.lower() for n in names}
    listed = files.select(F.explode("names").alias("name"))
    more = listed.groupBy(F.lower("name").alias("low")).agg(F.min("name").alias("name")).filter(~F.col("low").isin(sorted(known))).orderBy("low")
    wanted = [*names, *[r["name"] for r in more.collect()]]
    low = F.transform("names", F.lower)
    # array_position counts from 1 and gives 0 for a column that the file lacks.
    places = F.array(*[F.nullif(F.array_position(low, n.lower()), F.lit(0)) - 1 for n in wanted]).cast("array<int>")
    cells = [c for c in part.columns if c not in (*LINEAGE, CORRUPT)]
    rows = part.join(sized(staged(files.select(FILE, places.alias("_places")), "places")), FILE)
    packed = rows.select(F.array(*[column(c) for c in cells]).alias("_cells"), "_places", CORRUPT, *LINEAGE)
    return packed.select(*[F.get("_cells", F.get("_places", F.lit(i))).alias(n) for i, n in enumerate(wanted)], CORRUPT, *LINEAGE)


def base_of(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _pick_files(spark: SparkSession, rule: TableRule, inbox: str) -> tuple[str, str | None, str] | str:
    """(path, glob, name) to read, or why there is nothing to read."""
    glob = name_glob(rule.filename_pattern)
    try:
        seen = list_files(spark, inbox, glob).agg(F.min("name").alias("name"), F.min_by("path", "name").alias("path")).first()
        if not rule.ignore_empty and empty_files(spark, inbox, glob):
            return f"Empty file for {rule.filename_pattern}"
    except AnalysisException as error:
        if not is_absent(error):
            raise
        return f"{NO_FILE} {rule.filename_pattern}"
    if seen["name"] is None:
        return f"{NO_FILE} {rule.filename_pattern}"
    return (inbox, glob, seen["name"]) if rule.merge_files else (seen["path"], None, seen["name"])


class _Load:
    """The frames of one load. Text is parsed once into a staged table; all later passes read from that."""

    def __init__(self, spark: SparkSession, rule: TableRule, rules: Sequence[ColumnRule], layout: Layout,
                 at: datetime, raw: DataFrame):
        self.spark, self.rule, self.rules, self.layout, self.at = spark, rule, rules, layout, at
        self.history = StoredTable(spark, layout.table(rule, "all"), layout.fmt).held()
        self.current = CurrentTable(spark, layout.table(rule, "last"), layout.fmt).held()
        self.data = [c for c in raw.columns if c not in (*LINEAGE, CORRUPT)]
        self.keys, self.compare = merge_keys(rules), compare_column(rules)
        self.typed = staged(cleanse(raw, rules, trim=rule.trim), "typed")
        # One row per split and one per file: small beside the lines, but measured before they are broadcast.
        self.splits = staged(self._splits(), "splits")
        offsets = sized(staged(split_offsets(self.splits), "offsets"))
        self.lines = with_line_id(self.typed, offsets=offsets).drop(BLOCK, ROW)
        verdicts = staged(self._verdicts(), "verdicts")
        self.file_bytes = measured_bytes(verdicts)
        self.verdicts = broadcast_if_small(verdicts, self.file_bytes)
        self.accepted = self.verdicts.filter(F.col("_reason").isNull())
        self.rows = self._surviving()
        self.required = [r.column_name for r in required(rules)]
        self.profile = staged(self._profile(), "profile")

    def _splits(self) -> DataFrame:
        """Everything counted over all lines, in one pass; line offsets and verdicts both come from it."""
        return count_splits(self.typed, F.count_if(F.col(CORRUPT).isNotNull()).alias("_corrupt"),
                            F.sum(row_bytes(self.typed, self.data)).alias("_bytes"), *action_counts(self.rules))

    def _verdicts(self) -> DataFrame:
        """One row per file: counts, size, and why it is refused (if it is)."""
        sums = ["_corrupt", "_bytes", *[f"_null{i}" for i in range(len(required(self.rules)))]]
        counts = self.splits.groupBy(FILE).agg(F.sum("_lines").alias("_rows"), *[F.sum(c).alias(c) for c in sums])
        share = tolerance_column(F.lit(self.rule.reject_tolerance), F.col("_rows"))
        allowed = share * F.col("_rows")
        stop = aborted(self.rules, F.col("_rows"))
        bad_name = name_error(decoded(F.col(FILE))) if has_date(self.rule.filename_pattern) else F.lit(None)
        reason = (
            F.when(bad_name == INVALID_NAME_DATE, bad_name)
            .when(F.col("_corrupt") > allowed, F.format_string(TOO_CORRUPT, "_corrupt",
                                                               F.round(allowed, 2).cast("string")))
            .when(stop.isNotNull(), F.concat(F.lit("ICT_DRIVEN_ABORT on "), stop))
        )
        limit = row_limit(flagged_columns(self.rules))
        return counts.select("*", *self._file_facts(), limit.alias("_limit"), stop.alias("_abort"),
                             reason.alias("_reason"))

    def _file_facts(self) -> list[Column]:
        """What the name of a file says, worked out once per file instead of once per line."""
        path = decoded(F.col(FILE))
        parts = name_parts(path)
        dated = has_date(self.rule.filename_pattern)
        found = [(parts[p] if dated else F.lit(None)).cast("int").alias(f"_{p}") for p in PARTITIONS]
        return [base_name(path).alias("filename"), stem(path).alias("_stem"), *found]

    def _passes(self) -> Column:
        """A row that survives the error actions of its (accepted) file."""
        kept = ~rejected(self.rules) & (invalid_columns(self.rules) <= F.col("_limit"))
        return kept & F.col(CORRUPT).isNull() if self.rule.invalid_lines_generate else kept

    def _surviving(self) -> DataFrame:
        facts = ["_stem", *[f"_{p}" for p in PARTITIONS]]
        rows = self.lines.join(self.accepted.select(FILE, "_limit", *facts), FILE).filter(self._passes())
        return rows.select(*[column(c) for c in self.data], LINE, FILE, *facts)

    def _profile(self) -> DataFrame:
        """Non-null counts per file of the surviving rows; a file that lost all rows has zeros."""
        counted = column_profile(self.rows, self.data, FILE)
        return self.accepted.select(FILE).join(counted, FILE, "left").na.fill(0)

    def quality_errors(self) -> DataFrame:
        """Every error of the load, staged, since both the log and the counts need it."""
        table = self.rule.table_name
        found = [self._line_errors(), self._bad_files(),
                 check_profile(self.profile, self.data, self.keys, self.required, table, F.col(FILE))
                 .withColumnRenamed("filename", FILE)]
        if self.required:
            found.append(action_summary(self.verdicts, self.rules, "_rows", [FILE])
                         .withColumn("error_message", F.col("error_type")))
        if self.keys:
            repeated = duplicate_keys(self.rows, self.keys, table, F.col(FILE), FILE)
            found.append(repeated.withColumnRenamed("filename", FILE).join(
                self.profile.filter(self._filled()).select(FILE), FILE, "left_semi"))
        return staged(reduce(append, found), "errors")

    def _filled(self) -> Column:
        return F.greatest(F.lit(0).cast("long"), *[F.col(f"_n{i}") for i in range(len(self.data))]) > 0

    def _line_errors(self) -> DataFrame:
        """All errors that belong to a line, in one pass: those found while cleansing, refused rows (whole,
        as JSON), and nulls that remain in required columns which are not null throughout."""
        hollow = F.array_compact(F.array(*[
            F.when(F.col(f"_n{self.data.index(c)}") == 0, F.lit(c)) for c in self.required]).cast("array<string>"))
        files = self.verdicts.filter(F.col("_reason").isNull() | F.col("_abort").isNotNull()).join(
            self.profile.select(FILE, self._filled().alias("_filled"), hollow.alias("_hollow")), FILE, "left")
        # A join drops the hint its sides had; without it the lines would be shuffled by file.
        rows = self.lines.join(broadcast_if_small(files.select(FILE, "_limit", "_filled", "_hollow"), self.file_bytes), FILE)
        # Files that are not accepted have no profile.
        refused = F.col("_filled").isNotNull() & ~rejected(self.rules) & (invalid_columns(self.rules) > F.col("_limit"))
        whole = F.to_json(F.struct(*[column(c) for c in self.data]))
        parts = [F.coalesce(F.col(ERRORS), no_errors()),
                 F.when(refused, F.array(entry(F.lit(None), F.lit(INVALID_ROW), whole))).otherwise(no_errors())]
        for name in self.required:
            hit = (F.col("_filled") & self._passes() & column(name).isNull()
                   & ~F.array_contains("_hollow", F.lit(name)))
            parts.append(F.when(hit, F.array(entry(F.lit(name), F.lit(NULL_VALUE), F.lit(None))))
                         .otherwise(no_errors()))
        listed = rows.select(FILE, LINE, F.concat(*parts).alias(ERRORS))
        return error_lines(listed, self.rules, self.rule.table_name, [FILE])

    def _bad_files(self) -> DataFrame:
        bad = self.verdicts.filter(F.col("_reason").isNotNull() & F.col("_abort").isNull())
        return bad.select(FILE, F.lit("FILE_REJECTED").alias("error_type"), F.col("_reason").alias("error_message"),
                          F.when(F.col("_reason") == INVALID_NAME_DATE, F.col("filename")).alias("raw_value"),
                          F.greatest(F.col("_corrupt"), F.lit(1)).cast("long").alias("error_count"))

    def write_quarantine(self) -> None:
        """Corrupt lines as received, where the table asks for it."""
        if self.rule.invalid_lines_generate:
            bad = self.lines.filter(F.col(CORRUPT).isNotNull())
            bad.select(base_name(decoded(F.col(FILE))).alias("filename"), LINE, F.col(CORRUPT).alias("record"),
                       F.lit(self.at).alias("log_ts")).write.mode("append").parquet(
                self.layout.quarantine(self.rule.table_name))

    def _stamped(self, existing: T.StructType | None) -> DataFrame:
        dated = {p: F.col(f"_{p}") for p in PARTITIONS}
        stamped = stamp(self.rows, dated, F.col("_stem"), self.at, partition_types(existing))
        return without(stamped, "_stem", *[f"_{p}" for p in PARTITIONS])

    def write_tables(self, load_id: str) -> dict[str, Change]:
        """Write what the load adds to history and the current table's new state, neither visible before the load is
        committed. Without an accepted file nothing changes; columns that do not fit the stored ones end the load first."""
        totals = self.accepted.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("_bytes"), F.lit(0)).alias("size"),
                                   F.count_distinct(*[F.coalesce(f"_{p}", F.lit(0)) for p in PARTITIONS]).alias("days")
                                   ).first()
        if not totals["files"]:
            return {}
        # Files of one day fill one partition. Several days are first put together by day, or each task
        # would write a small file for each of them.
        spread = balanced if totals["days"] > 1 else (lambda df: df)
        history, current = self.history, self.current
        added = without(self._stamped(history.columns()), FILE)
        history_columns = history.accepts(added.schema)
        action, _ = mode_action(self.rule.ingestion_mode)
        batch = self._stamped(current.columns())
        columns = None if action == "snapshot" else current.accepts(without(batch, FILE).schema)
        target, kept = None, None if action == "append" else []
        if action in NEEDS_KEYS and current.content() is not None:
            stored, live = current.content()
            if action == "merge":
                # A merge fills the columns there are; it does not add any.
                columns = T.StructType([f for f in columns.fields if f.name in stored.names])
            # Only the days that hold a key of the batch are read and written anew.
            hit = current.touched(self.keys, batch, totals["size"])
            kept = [p for p in live if p not in set(hit)]
            target = current.read(hit, columns)
        state = without(batch, FILE) if action == "append" else apply_mode(
            self.rule.ingestion_mode, target, batch, self.keys, self.compare or PROCESS_DATE, (FILE, LINE), totals["size"])
        # A shuffled join leaves every day in all tasks.
        joined = target is not None and totals["size"] > BROADCAST_LIMIT
        changes = {history.name: Change(history_columns, [history.put(spread(added), load_id)], True)}
        columns = columns or evolved(None, state.schema)
        return changes | {current.name: current.change((balanced if joined else spread)(state), load_id, columns, kept)}

    def register(self) -> None:
        """Bring the catalog up to date with what has been committed."""
        if self.layout.database:
            for suffix in ("all", "last"):
                table = StoredTable(self.spark, self.layout.table(self.rule, suffix), self.layout.fmt)
                register_stored(table, f"{self.rule.table_name}_{suffix}", self.layout.database)
