"""Registration of stored tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidegate.sinks.ledger import LOAD
from tidegate.sinks.tables import PARTITIONS, StoredTable

# What to do when the table is already registered.
POLICIES = ("ignore", "errorexists", "overwrite", "append")


def register_table(spark: SparkSession, name: str, path: str, database: str = "default",
                   if_exists: str = "ignore", fmt: str = "parquet") -> bool:
    """Register a path as a table; True when the catalog was changed.

    The data stays where it is under every policy: ``overwrite`` drops the entry and points it anew.
    """
    if if_exists not in POLICIES:
        raise ValueError(f"if_exists must be one of {', '.join(POLICIES)}")
    full = f"`{database}`.`{name}`"
    if spark.catalog.tableExists(f"{database}.{name}"):
        if if_exists == "errorexists":
            raise ValueError(f"table {database}.{name} is already registered")
        if if_exists != "overwrite":
            find_partitions(spark, full)
            spark.catalog.refreshTable(f"{database}.{name}")
            return False
        spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING {fmt} LOCATION '{location}'")
    find_partitions(spark, full)
    return True


def find_partitions(spark: SparkSession, table: str) -> None:
    """Make partitions written to the path known to the catalog."""
    if spark.sql(f"SHOW COLUMNS IN {table}").filter("col_name = 'yyyy'").take(1):
        spark.sql(f"MSCK REPAIR TABLE {table}")


def register_stored(table: StoredTable, name: str, database: str = "default") -> None:
    """Give the catalog a table's committed folders, each as a partition, and take away those that are no longer live.

    The entry is never without its data: new partitions come before old ones go, and it is made anew only when columns change.
    The load of a row is a partition column beside the days.
    """
    spark, full = table.spark, f"`{database}`.`{name}`"
    columns, parts = table.content()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    data = [f for f in columns.fields if f.name not in PARTITIONS]
    dated = [f for f in columns.fields if f.name in PARTITIONS]
    wanted = [(f.name, f.dataType.simpleString()) for f in data] + [(LOAD, "string")] + [(f.name, f.dataType.simpleString()) for f in dated]
    if spark.catalog.tableExists(f"{database}.{name}") and spark.table(full).dtypes != wanted:
        spark.sql(f"DROP TABLE {full}")
    listed = ", ".join(f"`{n}` {kind}" for n, kind in wanted)
    location = table.path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({listed}) USING {table.fmt} PARTITIONED BY (`{LOAD}`, {', '.join(PARTITIONS)}) LOCATION '{location}'")
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}
    live = {day for part in parts for day in ([part] if "/" in part else table.days_of(part, columns))}
    for verb, days in (("ADD IF NOT EXISTS", sorted(live - known)), ("DROP IF EXISTS", sorted(known - live))):
        for low in range(0, len(days), 500):
            specs = [", ".join(f"{k}='{v}'" for k, v in (step.split("=", 1) for step in day.split("/"))) for day in days[low:low + 500]]
            joined = (" " if verb.startswith("ADD") else ", ").join(f"PARTITION ({s})" for s in specs)
            spark.sql(f"ALTER TABLE {full} {verb} {joined}")
    spark.catalog.refreshTable(f"{database}.{name}")
