"""Readers: each query writes a test table as files and reads them back under rules."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from suite.base import collector, decimal_text, table
from suite.functions import NAMES, named_orders
from tidegate.functions.files import base_name
from tidegate.operators.cleanse import cleanse
from tidegate.operators.quality import corrupt_verdict
from tidegate.operators.shape import rename_by_position
from tidegate.rules import ColumnRule, TableRule
from tidegate.session import fresh_path, staged
from tidegate.sources import discovery
from tidegate.sources.archive import archive_lines, parse_lines
from tidegate.sources.delimited import CORRUPT, read_delimited, read_fixed_width
from tidegate.sources.lines import with_line_id

SUITE, query = collector()

CUSTOMER = [ColumnRule("c_custkey", field_type="LONG"), ColumnRule("c_name"),
            ColumnRule("c_nationkey", field_type="INT"), ColumnRule("c_acctbal", field_type="DOUBLE"),
            ColumnRule("c_mktsegment")]
NAMES_OF_CUSTOMER = [r.column_name for r in CUSTOMER]
CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def as_csv(df, **options) -> str:
    path = fresh_path(df.sparkSession, "csv")
    df.write.options(**options).csv(path)
    return path


def typed(df, rules):
    return cleanse(df, rules).select([r.column_name for r in rules])


@query(CUSTOMER_SQL)
def csv_first_line(spark, folder):
    path = as_csv(table(spark, folder, "customer"), header=True)
    rule = TableRule("customer", header="FIRST LINE")
    return typed(read_delimited(spark, path, rule, NAMES_OF_CUSTOMER, lineage=False), CUSTOMER)


@query(CUSTOMER_SQL)
def csv_header_use(spark, folder):
    path = as_csv(table(spark, folder, "customer").toDF("key", "label", "nation", "balance", "segment"), header=True)
    rule = TableRule("customer", header="HEADER_USE")
    return typed(read_delimited(spark, path, rule, NAMES_OF_CUSTOMER, lineage=False), CUSTOMER)


@query(CUSTOMER_SQL)
def csv_positional(spark, folder):
    path = as_csv(table(spark, folder, "customer"))
    raw = read_delimited(spark, path, TableRule("customer"), ["a", "b", "c", "d", "e"], lineage=False,
                         capture_corrupt=False)
    return typed(rename_by_position(raw, NAMES_OF_CUSTOMER), CUSTOMER)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_semicolon(spark, folder):
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    path = as_csv(table(spark, folder, "orders").select(names), sep=";", header=True)
    rules = [ColumnRule(n, field_type=k) for n, k in zip(names, ("LONG", "LONG", "STRING", "DOUBLE", "STRING"))]
    rule = TableRule("orders", delimiter=";", header="FIRST_LINE")
    return typed(read_delimited(spark, path, rule, names, lineage=False), rules)


@query(r"""SELECT doc_id, replace(replace(text, chr(13), ' '), chr(10), ' ') AS text, lang FROM documents""")
def csv_quoted(spark, folder):
    flat = table(spark, folder, "documents").select("doc_id", F.translate("text", "\r\n", "  ").alias("text"), "lang")
    path = as_csv(flat, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rules = [ColumnRule("doc_id", field_type="LONG"), ColumnRule("text"), ColumnRule("lang")]
    rule = TableRule("documents", input_format="csv_quote")
    return typed(read_delimited(spark, path, rule, ["doc_id", "text", "lang"], lineage=False), rules)


@query("SELECT doc_id, text, lang FROM documents")
def csv_quoted_multiline(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    path = as_csv(docs, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rules = [ColumnRule("doc_id", field_type="LONG"), ColumnRule("text"), ColumnRule("lang")]
    rule = TableRule("documents", input_format="csv_quote_ml")
    return typed(read_delimited(spark, path, rule, ["doc_id", "text", "lang"], lineage=False), rules)


@query(r"""SELECT doc_id, regexp_replace(text, '[^\x{09}\x{0A}\x{20}-\x{7E}\x{A0}-\x{FF}]', '?', 'g') AS text FROM documents""")
def csv_latin1(spark, folder):
    latin = F.regexp_replace("text", r"[^\x{09}\x{0A}\x{20}-\x{7E}\x{A0}-\x{FF}]", "?")
    docs = table(spark, folder, "documents").select("doc_id", latin.alias("text"))
    path = as_csv(docs, encoding="ISO-8859-1", quoteAll=True, ignoreLeadingWhiteSpace=False,
                  ignoreTrailingWhiteSpace=False)
    rule = TableRule("documents", input_format="csv_quote_ml", charset="Latin1")
    rules = [ColumnRule("doc_id", field_type="LONG"), ColumnRule("text")]
    return typed(read_delimited(spark, path, rule, ["doc_id", "text"], lineage=False), rules)


@query("""SELECT p_partkey, p_name, p_type, p_size, CAST(p_retailprice AS DECIMAL(10,2)) AS p_retailprice FROM part""")
def fixed_width(spark, folder):
    line = F.concat(F.lpad(F.col("p_partkey").cast("string"), 12, "0"), F.rpad("p_name", 55, " "),
                    F.rpad("p_type", 25, " "), F.lpad(F.col("p_size").cast("string"), 6, " "),
                    F.lpad(decimal_text("p_retailprice"), 12, " "))
    path = fresh_path(spark, "fixed")
    table(spark, folder, "part").select(line.alias("value")).write.text(path)
    rules = [ColumnRule("p_partkey", field_type="LONG", column_size=12, field_order=1),
             ColumnRule("p_name", column_size=55, field_order=2), ColumnRule("p_type", column_size=25, field_order=3),
             ColumnRule("p_size", field_type="INT", column_size=6, field_order=4),
             ColumnRule("p_retailprice", field_type="DECIMAL", decimal_precision=10, decimal_scale=2, column_size=12,
                        field_order=5)]
    raw = read_fixed_width(spark, path, TableRule("part", input_format="fixed"), rules, lineage=False)
    return cleanse(raw, rules, trim=True).select([r.column_name for r in rules])


def broken_customers(spark, folder):
    """Customers in debt are written with too few fields."""
    whole = F.concat_ws(",", "c_custkey", "c_name", decimal_text("c_acctbal"))
    line = F.when(F.col("c_acctbal") < 0, F.concat_ws(",", "c_custkey", "c_name")).otherwise(whole)
    path = fresh_path(spark, "lines")
    table(spark, folder, "customer").select(line.alias("value")).write.text(path)
    return read_delimited(spark, path, TableRule("customer"), ["c_custkey", "c_name", "c_acctbal"], lineage=False)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS c_acctbal,
    CASE WHEN c_acctbal < 0 THEN c_custkey || ',' || c_name END AS bad_line FROM customer""")
def corrupt_split(spark, folder):
    raw = broken_customers(spark, folder)
    return raw.select("c_custkey", "c_acctbal", F.col(CORRUPT).alias("bad_line"))


@query("""WITH n AS (SELECT count(*) AS total_rows, CAST(count_if(c_acctbal < 0) AS BIGINT) AS corrupt_rows FROM customer)
    SELECT '10%' AS tolerance, total_rows, corrupt_rows, CAST(round(0.1 * total_rows, 6) AS DOUBLE) AS allowed_rows,
    corrupt_rows <= 0.1 * total_rows AS is_valid FROM n
    UNION ALL SELECT '60%', total_rows, corrupt_rows, round(0.6 * total_rows, 6), corrupt_rows <= 0.6 * total_rows FROM n""")
def corrupt_tolerance(spark, folder):
    raw = staged(broken_customers(spark, folder), "raw")
    sides = [corrupt_verdict(raw, CORRUPT, t).withColumn("tolerance", F.lit(t)) for t in ("10%", "60%")]
    return sides[0].unionByName(sides[1]).withColumn("allowed_rows", F.round("allowed_rows", 6))


@query("""SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS line_id FROM customer""")
def line_id(spark, folder):
    whole = table(spark, folder, "customer").select("c_custkey", "c_name")
    path = as_csv(whole.repartitionByRange(8, "c_custkey").sortWithinPartitions("c_custkey"), header=True)
    raw = read_delimited(spark, path, TableRule("customer", header="FIRST LINE"), ["c_custkey", "c_name"])
    rows = with_line_id(raw, per_file=False)
    return rows.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "c_name", "line_id")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def zip_scan(spark, folder):
    """Orders packed into archives of bounded size, then read back."""
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    orders = table(spark, folder, "orders").select(names)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            box = io.BytesIO()
            half = len(batch) // 2
            with zipfile.ZipFile(box, "w", zipfile.ZIP_DEFLATED) as out:
                out.writestr("a.csv", batch[:half].to_csv(index=False))
                out.writestr("sub/b.csv", batch[half:].to_csv(index=False))
            yield pd.DataFrame({"path": [f"/drop/{batch['o_orderkey'].iloc[0]}.zip"], "content": [box.getvalue()]})

    boxes = orders.mapInPandas(pack, "path string, content binary")
    rows = parse_lines(archive_lines(boxes), names)
    rules = [ColumnRule(n, field_type=k) for n, k in zip(names, ("LONG", "LONG", "STRING", "STRING"))]
    return typed(rows.select(names), rules)


PATTERNS = [TableRule("site", filename_pattern="site_<yyyy><mm><dd>_<hhmmss>.csv", merge_files=True),
            TableRule("site_monthly", filename_pattern="site_{yyyy}{mm}.csv"),
            TableRule("users", filename_pattern="users_{yyyy}_{mm}_{dd}.tar.gz"),
            TableRule("absent", filename_pattern="absent_<yyyy>.csv")]
MATCHED = rf"""n AS (SELECT o_orderkey, substr({NAMES}, 7) AS name FROM orders),
    m AS (SELECT o_orderkey, name, CASE WHEN regexp_full_match(name, 'site_\d{{8}}(_\d{{6}})?\.csv') THEN 'site'
    WHEN regexp_full_match(name, 'site_\d{{6}}\.csv') THEN 'site_monthly'
    WHEN regexp_full_match(name, 'users_\d{{4}}_\d{{2}}_\d{{2}}\.tar\.gz') THEN 'users' END AS table_name FROM n)"""


def listing(spark, folder):
    n = named_orders(spark, folder)
    return n.select("o_orderkey", "path", base_name(F.col("path")).alias("name"), "length")


@query(f"WITH {MATCHED} SELECT o_orderkey, name, table_name FROM m WHERE table_name IS NOT NULL")
def file_discovery(spark, folder):
    return discovery.match_files(listing(spark, folder), PATTERNS).select("o_orderkey", "name", "table_name")


@query(f"""WITH {MATCHED} SELECT DISTINCT table_name, name FROM m WHERE table_name = 'site' UNION ALL
    SELECT table_name, min(name) FROM m WHERE table_name <> 'site' GROUP BY 1""")
def file_selection(spark, folder):
    matched = discovery.match_files(listing(spark, folder), PATTERNS).select("table_name", "name").distinct()
    return discovery.selected_files(matched, PATTERNS)


@query(f"""WITH {MATCHED}, r AS (SELECT unnest(['site', 'site_monthly', 'users', 'absent']) AS table_name)
    SELECT table_name, 'No file matched absent_<yyyy>.csv' AS error_message FROM r
    WHERE table_name NOT IN (SELECT table_name FROM m WHERE table_name IS NOT NULL)""")
def file_no_match(spark, folder):
    return discovery.unmatched_tables(discovery.match_files(listing(spark, folder), PATTERNS), PATTERNS)
