"""Data-quality checks, error actions and their summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import DATE_ERROR, WRITTEN_DATE, collector, table, written_date
from tidegate.operators import actions, quality, shape
from tidegate.operators.cleanse import cleanse, error_lines
from tidegate.rules import ColumnRule
from tidegate.session import staged

SUITE, query = collector()

# Orders with synthesised nulls: the customer for high priority, the price for finished urgent orders.
HOLED = """SELECT o_orderkey AS line_id, o_orderkey, CASE WHEN o_orderpriority <> '2-HIGH' THEN o_custkey END AS o_custkey,
  CASE WHEN o_orderpriority <> '1-URGENT' OR o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority, CAST(NULL AS VARCHAR) AS note FROM orders"""


def holed_orders(spark, folder):
    o = table(spark, folder, "orders")
    p, s = F.col("o_orderpriority"), F.col("o_orderstatus")
    return o.select(F.col("o_orderkey").alias("line_id"), "o_orderkey",
                    F.when(p != "2-HIGH", F.col("o_custkey")).alias("o_custkey"),
                    F.when((p != "1-URGENT") | (s != "F"), F.col("o_totalprice")).alias("o_totalprice"),
                    F.when(s != "P", p).alias("o_orderpriority"), F.lit(None).cast("string").alias("note"))


BLANK_LINE = "CAST(NULL AS BIGINT) AS line_id"


@query(f"""SELECT 'orders' AS table_name, 'orders.csv' AS filename, {BLANK_LINE}, 'ALL_COLUMNS' AS column_name,
    'FILE_EMPTY_OR_ALL_NULL' AS error_message, CAST(1 AS BIGINT) AS error_count FROM orders
    HAVING count(nullif(o_orderstatus, o_orderstatus)) = 0""")
def dq_all_null(spark, folder):
    empty = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("line_id"), F.nullif(F.col("o_orderstatus"), F.col("o_orderstatus")).alias("a"),
        F.nullif(F.col("o_custkey"), F.col("o_custkey")).alias("b"))
    return quality.check_data_quality(empty, "orders", ["a"], "orders.csv", ["b"])


@query(f"""WITH h AS ({HOLED}) SELECT 'orders' AS table_name, 'orders.csv' AS filename, {BLANK_LINE},
    'o_custkey' AS column_name, 'NULL_KEY' AS error_message, count(*) - count(o_custkey) AS error_count FROM h
    UNION ALL SELECT 'orders', 'orders.csv', NULL, 'note', 'COLUMN ALL NULL', count(*) FROM h""")
def dq_null_key(spark, folder):
    df = holed_orders(spark, folder)
    data = [c for c in df.columns if c != "line_id"]
    return quality.check_profile(quality.column_profile(df, data), data, ["o_orderkey", "o_custkey"],
                                 ["note", "o_totalprice"], "orders", F.lit("orders.csv"))


@query(f"""SELECT 'lineitem' AS table_name, CAST(NULL AS VARCHAR) AS filename, {BLANK_LINE},
    'l_orderkey,l_linenumber' AS column_name, 'DUPLICATE_KEY' AS error_message, count(*) AS error_count
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dq_dup_key(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")


@query(f"""WITH h AS ({HOLED}) SELECT 'orders' AS table_name, line_id, 'o_custkey' AS column_name,
    'NULL_VALUE' AS error_message, CAST(1 AS BIGINT) AS error_count FROM h WHERE o_custkey IS NULL
    UNION ALL SELECT 'orders', line_id, 'o_totalprice', 'NULL_VALUE', 1 FROM h WHERE o_totalprice IS NULL""")
def dq_null_lines(spark, folder):
    return quality.null_lines(holed_orders(spark, folder), ["o_custkey", "o_totalprice"], "orders")


@query(f"""WITH h AS ({HOLED}), r AS (
    SELECT NULL AS line_id, 'o_custkey' AS column_name, 'NULL_KEY' AS error_message,
    count(*) - count(o_custkey) AS error_count FROM h
    UNION ALL SELECT NULL, 'note', 'COLUMN ALL NULL', count(*) FROM h
    UNION ALL SELECT NULL, 'o_custkey,o_orderpriority', 'DUPLICATE_KEY', count(*) FROM h
    GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1
    UNION ALL SELECT line_id, 'o_totalprice', 'NULL_VALUE', 1 FROM h WHERE o_totalprice IS NULL
    UNION ALL SELECT NULL, 'o_orderpriority', 'NULL_KEY', count(*) - count(o_orderpriority) FROM h)
    SELECT 'orders' AS table_name, 'orders.csv' AS filename, CAST(line_id AS BIGINT) AS line_id, column_name,
    error_message, CAST(error_count AS BIGINT) AS error_count FROM r""")
def dq_check_file(spark, folder):
    return quality.check_data_quality(holed_orders(spark, folder), "orders", ["o_custkey", "o_orderpriority"],
                                      "orders.csv", ["note", "o_totalprice"])


@query("""SELECT 'lineitem' AS table_name, l_partkey AS line_id, 'amount' AS column_name, 'TYPE_MISMATCH' AS error_type,
    'n' || l_suppkey AS raw_value, CAST(NULL AS VARCHAR) AS default_applied,
    'TYPE MISMATCH : Expected type INT, but found : [line ' || l_partkey || ', value=n' || l_suppkey || ']'
    AS error_message, CAST(1 AS BIGINT) AS error_count FROM lineitem WHERE l_returnflag = 'N'""")
def dq_type_mismatch(spark, folder):
    amount = (F.when(F.col("l_returnflag") == "N", F.concat(F.lit("n"), "l_suppkey"))
              .when(F.col("l_returnflag") == "A", "").otherwise(F.col("l_suppkey").cast("string")))
    raw = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("line_id"), amount.alias("amount"))
    rules = [ColumnRule("amount", field_type="INT")]
    return error_lines(cleanse(raw, rules), rules, "lineitem")


@query(f"""WITH h AS ({HOLED}) SELECT 'orders' AS table_name, line_id, 'o_totalprice' AS column_name,
    'ICT_DRIVEN' AS error_type, CAST(NULL AS VARCHAR) AS raw_value, CAST(NULL AS VARCHAR) AS default_applied,
    'Null value detected [not authorized], ICT count is incremented : [line ' || line_id || ', value=None]'
    AS error_message, CAST(1 AS BIGINT) AS error_count FROM h WHERE o_totalprice IS NULL""")
def dq_null_detail(spark, folder):
    h = holed_orders(spark, folder).select("line_id", F.col("o_totalprice").cast("string").alias("o_totalprice"))
    rules = [ColumnRule("o_totalprice", field_type="DOUBLE", is_nullable=False)]
    return error_lines(cleanse(h, rules), rules, "orders")


def required(action, *names, **more):
    return [ColumnRule(n, is_nullable=False, error_action=action, **more) for n in names]


@query(f"""WITH h AS ({HOLED}) SELECT line_id, o_custkey, o_totalprice FROM h
    WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL""")
def action_reject(spark, folder):
    kept = actions.apply_actions(holed_orders(spark, folder), required("REJECT", "o_custkey", "o_totalprice"))
    return kept.select("line_id", "o_custkey", "o_totalprice")


ICT_NAMES = ["o_custkey", "o_totalprice", "o_orderpriority"]


@query(f"""WITH h AS ({HOLED}) SELECT line_id, o_custkey, o_totalprice, o_orderpriority FROM h
    WHERE (o_custkey IS NULL)::INT + (o_totalprice IS NULL)::INT + (o_orderpriority IS NULL)::INT <= 1""")
def action_ict(spark, folder):
    kept = actions.apply_actions(holed_orders(spark, folder), required("ICT_DRIVEN", *ICT_NAMES))
    return kept.select("line_id", *ICT_NAMES)


@query(f"""WITH h AS ({HOLED}) SELECT line_id, o_custkey, o_totalprice, o_orderpriority FROM h
    WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL""")
def action_ict_strict(spark, folder):
    kept = actions.apply_actions(holed_orders(spark, folder), required("ICT_DRIVEN", *ICT_NAMES), min_allowed=0)
    return kept.select("line_id", *ICT_NAMES)


@query(f"""WITH h AS ({HOLED}), c AS (SELECT count(*) AS n, count(*) - count(o_custkey) AS bad,
    count(*) - count(o_totalprice) AS few FROM h)
    SELECT h.line_id, h.o_custkey FROM h, c WHERE NOT (bad > 0.5 * n) AND NOT (few > 0.1 * n)""")
def action_abort(spark, folder):
    rules = required("ICT_DRIVEN", "o_custkey", tolerance="50%") + required("ICT_DRIVEN", "o_totalprice", tolerance="10%")
    return actions.apply_actions(holed_orders(spark, folder), rules).select("line_id", "o_custkey")


@query(f"""WITH h AS ({HOLED}), c AS (SELECT count(*) AS n, count(*) - count(o_custkey) AS bad_cust,
    count_if(o_custkey IS NOT NULL AND o_totalprice IS NULL) AS bad_price,
    count_if(o_custkey IS NOT NULL AND o_orderpriority IS NULL) AS bad_prio FROM h)
    SELECT 'o_custkey' AS column_name, 'REJECT' AS error_type, CAST(bad_cust AS BIGINT) AS error_count FROM c WHERE bad_cust > 0
    UNION ALL SELECT 'o_totalprice', 'LOG_ONLY', CAST(bad_price AS BIGINT) FROM c WHERE bad_price > 0
    UNION ALL SELECT 'o_orderpriority', 'ICT_DRIVEN_ABORT', CAST(bad_prio AS BIGINT) FROM c WHERE bad_prio > 0.1 * n""")
def action_log(spark, folder):
    rules = (required("REJECT", "o_custkey") + required("LOG_ONLY", "o_totalprice")
             + required("ICT_DRIVEN", "o_orderpriority", tolerance="10%"))
    counts = holed_orders(spark, folder).agg(F.count(F.lit(1)).alias("n"), *actions.action_counts(rules))
    return actions.action_summary(counts, rules, "n")


ERRORS = f"""t AS (SELECT o_orderkey, {WRITTEN_DATE} AS raw, o_orderpriority FROM orders),
    e AS (SELECT CASE WHEN ({DATE_ERROR}) = 'INVALID_DATE' THEN 'Invalid date' ELSE ({DATE_ERROR}) END AS error_message,
    CAST(1 AS BIGINT) AS error_count FROM t WHERE ({DATE_ERROR}) IS NOT NULL
    UNION ALL SELECT 'Null value detected', CAST(2 AS BIGINT) FROM t WHERE raw IS NULL)"""


def error_frame(spark, folder):
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("line_id"), written_date().alias("raw"))
    rules = [ColumnRule("raw", field_type="DATE")]
    lines = error_lines(staged(cleanse(o, rules), "typed"), rules, "orders")
    text = F.when(F.col("error_message") == "INVALID_DATE", "Invalid date").otherwise(F.col("error_message"))
    found = lines.select("column_name", text.alias("error_message"), "error_count")
    nulls = o.filter("raw IS NULL").select(F.lit("Null value detected").alias("error_message"),
                                           F.lit(2).cast("bigint").alias("error_count"))
    return found.unionByName(nulls, allowMissingColumns=True)


@query(f"""WITH {ERRORS} SELECT error_message, CAST(sum(error_count) AS BIGINT) AS total_count,
    CASE WHEN contains(lower(error_message), 'null') THEN 'null' ELSE 'format' END AS family
    FROM e GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""")
def error_summary(spark, folder):
    return quality.error_summary(error_frame(spark, folder))


@query(f"""WITH {ERRORS}, i AS (SELECT CAST(coalesce(sum(error_count) FILTER (contains(error_message, 'Invalid')), 0)
    AS BIGINT) AS invalid_rows FROM e), n AS (SELECT count(*) AS total_rows FROM orders)
    SELECT total_rows, invalid_rows, total_rows - invalid_rows AS cleaned_rows FROM i, n""")
def clean_rows(spark, folder):
    total = table(spark, folder, "orders").count()
    return quality.cleaned_rows(total, error_frame(spark, folder))


@query(f"""WITH h AS ({HOLED}) SELECT 'has_customer' AS expectation, count(*) AS total_rows,
    CAST(count_if(o_custkey IS NULL) AS BIGINT) AS violations FROM h UNION ALL
    SELECT 'dear', count(*), CAST(count_if(NOT coalesce(o_totalprice > 1000, FALSE)) AS BIGINT) FROM h""")
def expectations(spark, folder):
    return quality.expectations(holed_orders(spark, folder),
                                {"has_customer": "o_custkey IS NOT NULL", "dear": "o_totalprice > 1000"})


@query("SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name, c_mktsegment FROM customer")
def trim_all(spark, folder):
    c = table(spark, folder, "customer")
    return shape.trim_all(c.select("c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
                                   F.concat("c_mktsegment", F.lit("  ")).alias("c_mktsegment")))


@query("""SELECT 'customer' AS table_name, 'c.csv' AS filename, 'MISSING_COLUMN' AS error_type, m.column_name,
    n.row_count FROM (SELECT unnest(['c_phone', 'c_comment']) AS column_name) m, (SELECT count(*) AS row_count FROM customer) n""")
def missing_columns(spark, folder):
    c = table(spark, folder, "customer")
    wanted = ["c_custkey", "C_NAME", "c_phone", "c_comment"]
    errors = shape.missing_column_errors(c, wanted, "customer", "c.csv")
    return errors.withColumn("row_count", c.select(F.count(F.lit(1))).scalar())


@query("""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
    CAST(NULL AS VARCHAR) AS c_phone FROM customer""")
def fill_columns(spark, folder):
    return shape.fill_columns(table(spark, folder, "customer"), ["c_custkey", "c_phone"])
