"""Column and table rules: the configuration that drives a load."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.settings import as_bool, as_text

# The headings under which a setting may appear in a configuration sheet.
COLUMN_HEADINGS = {
    "table_name": ("Delta Table Name", "table_name"),
    "column_name": ("Column Name", "column_name"),
    "field_type": ("Field type", "field_type"),
    "storage_type": ("Storage Type", "storage_type"),
    "decimal_precision": ("Decimal precision", "decimal_precision"),
    "decimal_scale": ("Decimal scale", "decimal_scale"),
    "field_order": ("Field Order", "field_order"),
    "column_size": ("Column Size", "column_size"),
    "is_nullable": ("Is Nullable", "is_nullable"),
    "transformation_type": ("Transformation Type", "transformation_type"),
    "transformation_pattern": ("Transformation pattern", "transformation_pattern"),
    "regex_replacement": ("Regex replacement", "regex_replacement"),
    "enumeration": ("Enumeration Values", "Enumeration list", "enumeration"),
    "enumeration_table": ("Enumeration Table", "enumeration_table"),
    "default_invalid": ("Default Value when Invalid", "Default when invalid", "default_invalid"),
    "error_action": ("Error action", "error_action"),
    "tolerance": ("Rejected line per file tolerance", "tolerance"),
    "special": ("Is Special", "special"),
    "is_merge_key": ("isMergeKey", "is_merge_key"),
    "is_start_validity": ("isStartValidity", "isExtractValidity", "is_start_validity"),
}
TABLE_HEADINGS = {
    "table_name": ("Delta Table Name", "table_name"),
    "source_table": ("Source Table", "source_table"),
    "filename_pattern": ("Filename Pattern", "filename_pattern"),
    "input_format": ("Input Format", "input_format"),
    "zone": ("Output Zone", "Input Zone", "zone"),
    "ingestion_mode": ("Ingestion mode", "ingestion_mode"),
    "delimiter": ("Input delimiter", "delimiter"),
    "charset": ("Input charset", "charset"),
    "header": ("Input header", "header"),
    "trim": ("Trim", "trim"),
    "delete_columns_allowed": ("Delete Columns Allowed", "Delete Columns", "delete_columns_allowed"),
    "ignore_empty": ("Ignore empty files", "ignore_empty"),
    "invalid_lines_generate": ("Invalid Lines Generate", "invalid_lines_generate"),
    "reject_tolerance": ("Rejected line per file tolerance", "reject_tolerance"),
    "merge_files": ("Merge concordant file", "Merge concomitant file", "merge_files"),
}

# Accepted input formats, error actions, special roles.
CSV_FORMATS = ("csv", "csv_quote", "csv_quote_ml", "csv_deprecated")
FORMATS = (*CSV_FORMATS, "fixed")
ERROR_ACTIONS = ("REJECT", "ICT_DRIVEN", "LOG_ONLY")
MERGE_KEY, START_VALIDITY = "ismergekey", "isstartvalidity"


@dataclass(frozen=True)
class ColumnRule:
    """How one column of a table is typed, cleansed and checked."""

    column_name: str
    table_name: str = ""
    field_type: str = "STRING"
    storage_type: str | None = None
    decimal_precision: int | None = None
    decimal_scale: int | None = None
    field_order: int | None = None
    column_size: int = 1
    is_nullable: bool = True
    transformation_type: str | None = None
    transformation_pattern: str | None = None
    regex_replacement: str | None = None
    enumeration: tuple[str, ...] = ()
    # Path of a stored list of allowed values, for lists too long to be written here.
    enumeration_table: str | None = None
    default_invalid: str | None = None
    error_action: str = "ICT_DRIVEN"
    tolerance: str | None = None
    is_merge_key: bool = False
    is_start_validity: bool = False

    @classmethod
    def of(cls, row: Mapping[str, Any]) -> ColumnRule:
        given = by_setting(row, COLUMN_HEADINGS)
        role = (as_text(given.get("special")) or "").lower()
        action = (as_text(given.get("error_action")) or "ICT_DRIVEN").upper()
        listed = as_text(given.get("enumeration")) or ""
        return cls(
            column_name=str(given["column_name"]).strip(),
            table_name=str(given.get("table_name") or "").strip(),
            field_type=(as_text(given.get("field_type")) or "STRING").upper(),
            storage_type=as_text(given.get("storage_type")),
            decimal_precision=as_int(given.get("decimal_precision")),
            decimal_scale=as_int(given.get("decimal_scale")),
            field_order=as_int(given.get("field_order")),
            column_size=max(as_int(given.get("column_size")) or 1, 1),
            is_nullable=as_bool(given.get("is_nullable"), True),
            transformation_type=(as_text(given.get("transformation_type")) or "").lower() or None,
            transformation_pattern=as_text(given.get("transformation_pattern")),
            regex_replacement=as_text(given.get("regex_replacement")),
            enumeration=tuple(v.strip() for v in listed.split(",") if v.strip()),
            enumeration_table=as_text(given.get("enumeration_table")),
            default_invalid=as_text(given.get("default_invalid")),
            error_action=action,
            tolerance=as_text(given.get("tolerance")),
            is_merge_key=role == MERGE_KEY or as_bool(given.get("is_merge_key"), False),
            is_start_validity=role == START_VALIDITY or as_bool(given.get("is_start_validity"), False),
        )


@dataclass(frozen=True)
class TableRule:
    """Where the files of a table come from and how they are read and stored."""

    table_name: str
    source_table: str | None = None
    filename_pattern: str = ""
    input_format: str = "csv"
    zone: str = "internal"
    ingestion_mode: str = ""
    delimiter: str | None = None
    charset: str = "UTF-8"
    header: str | None = None
    trim: bool = True
    delete_columns_allowed: bool = False
    ignore_empty: bool = True
    invalid_lines_generate: bool = False
    reject_tolerance: str = "10%"
    merge_files: bool = False

    @classmethod
    def of(cls, row: Mapping[str, Any]) -> TableRule:
        given = by_setting(row, TABLE_HEADINGS)
        return cls(
            table_name=str(given["table_name"]).strip(),
            source_table=as_text(given.get("source_table")),
            filename_pattern=as_text(given.get("filename_pattern")) or "",
            input_format=(as_text(given.get("input_format")) or "csv").lower(),
            zone=(as_text(given.get("zone")) or "internal").lower(),
            ingestion_mode=as_text(given.get("ingestion_mode")) or "",
            delimiter=given.get("delimiter"),
            charset=as_text(given.get("charset")) or "UTF-8",
            header=as_text(given.get("header")),
            trim=as_bool(given.get("trim"), True),
            delete_columns_allowed=as_bool(given.get("delete_columns_allowed"), False),
            ignore_empty=as_bool(given.get("ignore_empty"), True),
            invalid_lines_generate=as_bool(given.get("invalid_lines_generate"), False),
            reject_tolerance=as_text(given.get("reject_tolerance")) or "10%",
            merge_files=as_bool(given.get("merge_files"), False),
        )


def as_int(value: Any) -> int | None:
    text = as_text(value)
    return None if text is None else int(float(text))


def by_setting(row: Mapping[str, Any], headings: Mapping[str, tuple[str, ...]]) -> dict[str, Any]:
    """Rename the headings of a configuration row to canonical settings, ignoring case and spacing."""
    def fold(text: str) -> str:
        return text.replace("_", " ").strip().lower()

    setting_of = {fold(heading): setting for setting, names in headings.items() for heading in names}
    found: dict[str, Any] = {}
    for heading, value in row.items():
        setting = setting_of.get(fold(heading))
        if setting and (found.get(setting) is None):
            found[setting] = value
    return found


def ordered(rules: Iterable[ColumnRule]) -> list[ColumnRule]:
    """Rules by Field Order; those without one keep their place at the end."""
    return sorted(rules, key=lambda r: (r.field_order is None, r.field_order or 0))


def for_table(rules: Iterable[ColumnRule], table: str) -> list[ColumnRule]:
    return [r for r in rules if r.table_name == table]


def merge_keys(rules: Iterable[ColumnRule]) -> list[str]:
    return [r.column_name for r in rules if r.is_merge_key]


def compare_column(rules: Iterable[ColumnRule]) -> str | None:
    return next((r.column_name for r in rules if r.is_start_validity), None)


def read_settings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Configuration table as text columns."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("quote", '"').option("escape", '"')
    df = reader.load(path)
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def load_column_rules(spark: SparkSession, path: str, fmt: str = "csv") -> list[ColumnRule]:
    return [ColumnRule.of(row.asDict()) for row in read_settings(spark, path, fmt).toLocalIterator()]


def load_table_rules(spark: SparkSession, path: str, fmt: str = "csv") -> list[TableRule]:
    return [TableRule.of(row.asDict()) for row in read_settings(spark, path, fmt).toLocalIterator()]


def rules_frame(spark: SparkSession, rules: Iterable[ColumnRule | TableRule], kind: type) -> DataFrame:
    """Rules as a table, for storing or inspecting them with SQL."""
    names = [f.name for f in fields(kind)]
    schema = ", ".join(f"{n} string" for n in names)
    def text(value) -> str | None:
        return (",".join(value) or None) if isinstance(value, tuple) else None if value is None else str(value)

    rows = [Row(*[text(getattr(r, n)) for n in names]) for r in rules]
    return spark.createDataFrame(rows, schema)
