"""Which files belong to which table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.files import base_name, name_date, name_error, name_parts, name_regex
from tidegate.rules import TableRule


def folder_frame(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """(path, name, length) of the files below a folder that hold data; contents are not read."""
    files = folder_frame(spark, folder, glob)
    return files.select("path", base_name(F.col("path")).alias("name"), "length")


def file_identity(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """(_file, length, modified) of the files that hold data, under the paths a scan gives them."""
    kept = folder_frame(spark, folder, glob).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return kept.toDF("_file", "length", "modified")


def empty_files(spark: SparkSession, folder: str, glob: str | None = None) -> int:
    """Number of files without content. A scan skips these, the listing behind it does not."""
    files = folder_frame(spark, folder, glob)
    return len(files.inputFiles()) - files.select("path").count()


def match_files(listing: DataFrame, rules: Sequence[TableRule]) -> DataFrame:
    """Add ``table_name`` for every rule whose name pattern fits; a file may feed several tables.

    The rules become one expression per row, so there is no join between listing and configuration.
    """
    name = F.col("name")
    hits = F.array(*[F.when(name.rlike(name_regex(r.filename_pattern)), F.lit(r.table_name)) for r in rules])
    return listing.select("*", F.explode_outer(hits).alias("table_name")).filter(F.col("table_name").isNotNull())


def selected_files(matched: DataFrame, rules: Sequence[TableRule]) -> DataFrame:
    """All matches where files are merged, otherwise the first by name."""
    merging = [r.table_name for r in rules if r.merge_files]
    lowest = matched.groupBy("table_name").agg(F.min("name").alias("_first"))
    keep = F.col("table_name").isin(merging) | (F.col("name") == F.col("_first"))
    return matched.join(lowest, "table_name").filter(keep).drop("_first")


def unmatched_tables(matched: DataFrame, rules: Sequence[TableRule]) -> DataFrame:
    """Rules without a file, with the message for the execution log."""
    spark = matched.sparkSession
    wanted = spark.createDataFrame([(r.table_name, r.filename_pattern) for r in rules],
                                   "table_name string, filename_pattern string")
    missing = wanted.join(matched.select("table_name").distinct(), "table_name", "left_anti")
    return missing.select("table_name", F.concat(F.lit("No file matched "), "filename_pattern").alias("error_message"))


def dated_names(listing: DataFrame) -> DataFrame:
    """Date parts, calendar date and naming error of every file."""
    name = F.col("name")
    return listing.select("*", name_parts(name).alias("_p"), name_date(name).alias("file_date"),
                          name_error(name).alias("error_message")).select(
        *listing.columns, "_p.*", "file_date", "error_message")
