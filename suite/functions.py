"""Text, type, date, number and file-name functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite.base import DATE_ERROR, PARSED_DATE, WRITTEN_DATE, collector, decimal_text, table, written_date
from tidegate.functions import checks, files, numbers, settings
from tidegate.functions.dates import parse_temporal, shape_of, temporal_default
from tidegate.functions.text import blank_to_null, concat_text, transform
from tidegate.functions.typing import safe_cast, spark_type
from tidegate.operators.cleanse import cleanse, error_lines
from tidegate.rules import ColumnRule

SUITE, query = collector()


@query("""SELECT c_custkey, upper(c_mktsegment) AS upper_text, lower(c_name) AS lower_text,
    upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS capital_text FROM customer""")
def str_case(spark, folder):
    c, seg = table(spark, folder, "customer"), F.col("c_mktsegment")
    return c.select("c_custkey", transform(seg, "uppercase").alias("upper_text"),
                    transform(F.col("c_name"), "lowercase").alias("lower_text"),
                    transform(seg, "capitalize").alias("capital_text"))


@query("""WITH p AS (SELECT c_custkey, '  ' || c_name || repeat(' ', c_nationkey % 4) AS v FROM customer)
    SELECT c_custkey, trim(v) AS both_sides, ltrim(v) AS left_side, rtrim(v) AS right_side,
    nullif(trim(substr(v, 1, 2 + c_custkey % 2)), '') AS blank_null FROM p""")
def str_trim(spark, folder):
    padded = F.concat(F.lit("  "), "c_name", F.repeat(F.lit(" "), F.col("c_nationkey") % 4))
    p = table(spark, folder, "customer").select("c_custkey", padded.alias("v"))
    cut = F.substring("v", F.lit(1), (F.lit(2) + F.col("c_custkey") % 2).cast("int"))
    return p.select("c_custkey", transform(F.col("v"), "trim").alias("both_sides"),
                    transform(F.col("v"), "ltrim").alias("left_side"),
                    transform(F.col("v"), "rtrim").alias("right_side"), blank_to_null(cut).alias("blank_null"))


@query(r"""SELECT c_custkey, regexp_replace(c_name, '#', '_', 'g') AS replaced,
    regexp_replace(c_name, '[0-9]', '', 'g') AS removed, regexp_extract(c_name, 'Customer#0*(\d+)', 1) AS extracted,
    regexp_extract(c_mktsegment, 'B(.*)G', 1) AS unmatched FROM customer""")
def str_regex(spark, folder):
    name = F.col("c_name")
    return table(spark, folder, "customer").select(
        "c_custkey", transform(name, "regex", "#", "_").alias("replaced"),
        transform(name, "regex_replace", "[0-9]").alias("removed"),
        transform(name, "regex_extract", r"Customer#0*(\d+)").alias("extracted"),
        transform(F.col("c_mktsegment"), "regex_extract", "B(.*)G").alias("unmatched"))


@query("""SELECT c_custkey, substr(c_name, 1, 4) AS piece, left(c_name, 3) AS head, right(c_name, 3) AS tail
    FROM customer""")
def str_slice(spark, folder):
    name = F.col("c_name")
    return table(spark, folder, "customer").select(
        "c_custkey", transform(name, "substring", "1,4").alias("piece"), transform(name, "left", "3").alias("head"),
        transform(name, "right", "3").alias("tail"))


@query("""SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS left_pad, rpad(c_mktsegment, 9, 'X') AS right_pad
    FROM customer""")
def str_pad(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", transform(F.col("c_custkey").cast("string"), "lpad", "5,0").alias("left_pad"),
        transform(F.col("c_mktsegment"), "rpad", "9,X").alias("right_pad"))


@query("""SELECT c_custkey, c_name || ' ' || c_mktsegment AS joined,
    c_name || ' ' || nullif(c_mktsegment, 'BUILDING') AS joined_null FROM customer""")
def str_concat(spark, folder):
    seg = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        "c_custkey", concat_text(F.col("c_name"), seg).alias("joined"),
        concat_text(F.col("c_name"), F.nullif(seg, F.lit("BUILDING"))).alias("joined_null"))


MAIL = "lower(replace(c_name, '#', '.')) || CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN '@' " \
       "WHEN 'FURNITURE' THEN '@mail' WHEN 'HOUSEHOLD' THEN '@mail.example.com' ELSE '@example.org' END"


@query(f"""SELECT c_custkey, {MAIL} AS email, regexp_matches({MAIL},
    '^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{{2,}}$') AS is_email FROM customer""")
def check_email(spark, folder):
    tail = (F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_mktsegment") == "MACHINERY", "@")
            .when(F.col("c_mktsegment") == "FURNITURE", "@mail")
            .when(F.col("c_mktsegment") == "HOUSEHOLD", "@mail.example.com").otherwise("@example.org"))
    mail = table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lower(F.translate("c_name", "#", ".")), tail).alias("email"))
    return mail.withColumn("is_email", checks.is_email(F.col("email")))


ADDRESS = "CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN c_custkey || ' Main Street' " \
          "WHEN 'FURNITURE' THEN 'Avenue des Champs-Elysées ' || c_nationkey WHEN 'HOUSEHOLD' THEN '  ' ELSE '@' || c_name END"


@query(f"""SELECT c_custkey, {ADDRESS} AS address, regexp_matches(trim({ADDRESS}),
    '^[0-9A-Za-zÀ-ÖØ-öø-ÿ][0-9A-Za-zÀ-ÖØ-öø-ÿ #,.''/-]*$') AS is_address FROM customer""")
def check_address(spark, folder):
    seg = F.col("c_mktsegment")
    text = (F.when(seg == "BUILDING", "").when(seg == "MACHINERY", F.concat("c_custkey", F.lit(" Main Street")))
            .when(seg == "FURNITURE", F.concat(F.lit("Avenue des Champs-Elysées "), "c_nationkey"))
            .when(seg == "HOUSEHOLD", "  ").otherwise(F.concat(F.lit("@"), "c_name")))
    address = table(spark, folder, "customer").select("c_custkey", text.alias("address"))
    return address.withColumn("is_address", checks.is_address(F.col("address")))


@query("""SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN c_mktsegment
    ELSE 'OTHER' END AS c_mktsegment,
    CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'INVALID_ENUM' END AS error_type
    FROM customer""")
def check_enum(spark, folder):
    rule = ColumnRule("c_mktsegment", transformation_type="enumeration",
                      enumeration=("BUILDING", "MACHINERY", "HOUSEHOLD"), default_invalid="OTHER")
    typed = cleanse(table(spark, folder, "customer").select("c_custkey", "c_mktsegment"), [rule])
    return typed.select("c_custkey", "c_mktsegment", F.get("_errors", F.lit(0))["error_type"].alias("error_type"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(12,2)) AS exact FROM lineitem""")
def decimal_comma(spark, folder):
    text = F.translate(decimal_text("l_extendedprice"), ".", ",")
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", text.alias("t")).select(
        "l_orderkey", "l_linenumber", "l_partkey", safe_cast(F.col("t"), spark_type("DOUBLE")).alias("price"),
        safe_cast(F.col("t"), spark_type("DECIMAL", 12, 2)).alias("exact"))


CAST_TEXT = "CASE l_returnflag WHEN 'A' THEN CAST(l_partkey AS VARCHAR) WHEN 'N' THEN 'n' || l_partkey ELSE " \
            "CASE WHEN l_linenumber > 3 THEN '' ELSE CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) END END"


@query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, {CAST_TEXT} AS raw, l_linestatus FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, raw,
    CASE WHEN regexp_full_match(raw, '[+-]?[0-9]+') THEN try_cast(raw AS INTEGER) END AS as_int,
    CASE WHEN regexp_full_match(raw, '[+-]?[0-9]+') THEN try_cast(raw AS BIGINT) END AS as_long,
    try_cast(raw AS DOUBLE) AS as_double, try_cast(CASE l_linestatus WHEN 'O' THEN 'true' ELSE 'oui' END AS BOOLEAN)
    AS as_bool FROM t""")
def safe_cast_types(spark, folder):
    raw = (F.when(F.col("l_returnflag") == "A", F.col("l_partkey").cast("string"))
           .when(F.col("l_returnflag") == "N", F.concat(F.lit("n"), "l_partkey"))
           .when(F.col("l_linenumber") > 3, "").otherwise(F.col("l_tax").cast("decimal(4,2)").cast("string")))
    word = F.when(F.col("l_linestatus") == "O", "true").otherwise("oui")
    t = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", raw.alias("raw"),
                                                word.alias("w"))
    return t.select("l_orderkey", "l_linenumber", "l_partkey", "raw",
                    *[safe_cast(F.col("raw"), spark_type(k)).alias(n)
                      for k, n in (("INT", "as_int"), ("LONG", "as_long"), ("DOUBLE", "as_double"))],
                    safe_cast(F.col("w"), spark_type("BOOLEAN")).alias("as_bool"))


@query("""SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN TRUE
    WHEN c_mktsegment = 'FURNITURE' THEN FALSE ELSE c_acctbal > 0 END AS flag FROM customer""")
def config_bool(spark, folder):
    seg = F.col("c_mktsegment")
    word = (F.when(seg == "BUILDING", " Oui ").when(seg == "MACHINERY", "Y").when(seg == "AUTOMOBILE", "1")
            .when(seg == "FURNITURE", "NON").otherwise("maybe"))
    return table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, settings.bool_column(word, True))
        .otherwise(settings.bool_column(word, False)).alias("flag"))


@query("""WITH n AS (SELECT l_suppkey, count(*) AS total FROM lineitem GROUP BY 1),
    r AS (SELECT l_suppkey, total, CASE l_suppkey % 4 WHEN 0 THEN '10%' WHEN 1 THEN '5' WHEN 2 THEN '0,5 %' ELSE 'n/a' END
    AS raw FROM n) SELECT l_suppkey, total, raw, round(CASE raw WHEN '10%' THEN 0.1 WHEN '5' THEN 5.0 / total
    WHEN '0,5 %' THEN 0.005 ELSE 0.0 END, 9) AS rate FROM r""")
def tolerance_rate(spark, folder):
    n = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("total"))
    m = F.col("l_suppkey") % 4
    raw = F.when(m == 0, "10%").when(m == 1, "5").when(m == 2, "0,5 %").otherwise("n/a")
    return n.withColumn("raw", raw).withColumn(
        "rate", F.round(settings.tolerance_column(F.col("raw"), F.col("total")), 9))


@query(f"""WITH t AS (SELECT o_orderkey, {WRITTEN_DATE} AS raw FROM orders)
    SELECT o_orderkey, raw, {PARSED_DATE} AS parsed FROM t""")
def date_parse(spark, folder):
    t = table(spark, folder, "orders").select("o_orderkey", written_date().alias("raw"))
    t = t.withColumn("s", shape_of(F.col("raw")))
    return t.select("o_orderkey", "raw", parse_temporal(F.col("raw"), T.DateType(), None, F.col("s")).alias("parsed"))


@query(f"""WITH t AS (SELECT o_orderkey, {WRITTEN_DATE} AS raw FROM orders),
    e AS (SELECT o_orderkey, raw, {DATE_ERROR} AS error_type FROM t)
    SELECT 'orders' AS table_name, o_orderkey AS line_id, 'order_date' AS column_name, raw AS raw_value, error_type
    FROM e WHERE error_type IS NOT NULL""")
def date_errors(spark, folder):
    t = table(spark, folder, "orders").select(F.col("o_orderkey").alias("line_id"), written_date().alias("order_date"))
    rules = [ColumnRule("order_date", field_type="DATE")]
    return error_lines(cleanse(t, rules), rules, "orders").select(
        "table_name", "line_id", "column_name", "raw_value", "error_type")


@query(f"""WITH t AS (SELECT o_orderkey, {WRITTEN_DATE} AS raw FROM orders)
    SELECT o_orderkey, coalesce({PARSED_DATE}, DATE '2000-01-01') AS order_date FROM t""")
def date_default(spark, folder):
    t = table(spark, folder, "orders").select("o_orderkey", written_date().alias("raw"))
    day = T.DateType()
    return t.select("o_orderkey", F.coalesce(parse_temporal(F.col("raw"), day), temporal_default("01/01/2000", day))
                    .alias("order_date"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, strftime(o_orderdate, '%d/%m/%Y') AS written,
    CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
    CAST(o_orderdate AS DATE) + 10 AS due FROM orders""")
def date_funcs(spark, folder):
    day = F.to_date("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", day.alias("order_day"), F.date_format(day, "dd/MM/yyyy").alias("written"),
        F.datediff(day, F.lit("1995-01-01").cast("date")).alias("days"), F.date_add(day, 10).alias("due"))


@query("""SELECT c_custkey, abs(c_acctbal) AS size, round(c_acctbal, 1) AS rounded,
    CAST(ceil(c_acctbal) AS BIGINT) AS up, CAST(floor(c_acctbal) AS BIGINT) AS down FROM customer""")
def math_funcs(spark, folder):
    b = F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        "c_custkey", F.abs(b).alias("size"), F.round(b, 1).alias("rounded"), F.ceil(b).alias("up"),
        F.floor(b).alias("down"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * l_quantity, 2) AS revenue,
    round(l_discount / nullif(l_tax, 0) * 100, 4) AS percentage,
    round((l_extendedprice - l_quantity) / nullif(l_quantity, 0) * 100, 4) AS growth, l_quantity * 2 AS doubled
    FROM lineitem""")
def formulas(spark, folder):
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(numbers.revenue(price, quantity), 2).alias("revenue"),
        F.round(numbers.percentage(F.col("l_discount"), F.col("l_tax")), 4).alias("percentage"),
        F.round(numbers.growth_rate(price, quantity), 4).alias("growth"), (quantity * 2).alias("doubled"))


@query("""SELECT o_orderkey, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'Unknown') AS priority FROM orders""")
def coalesce_default(spark, folder):
    given = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return table(spark, folder, "orders").select("o_orderkey", F.coalesce(given, F.lit("Unknown")).alias("priority"))


@query("""SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_nationkey ELSE -1 END AS nation,
    CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_acctbal AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS balance
    FROM customer""")
def default_invalid(spark, folder):
    seg = F.col("c_mktsegment")
    nation = F.when(seg.isin("BUILDING", "MACHINERY"), F.col("c_nationkey").cast("string")).when(
        seg == "HOUSEHOLD", "?")
    balance = F.when(seg == "BUILDING", decimal_text("c_acctbal")).otherwise(F.lower(seg))
    raw = table(spark, folder, "customer").select("c_custkey", nation.alias("nation"), balance.alias("balance"))
    rules = [ColumnRule("nation", field_type="INT", default_invalid="-1"),
             ColumnRule("balance", field_type="DECIMAL", decimal_precision=12, decimal_scale=2, default_invalid="0")]
    return cleanse(raw, rules).select("c_custkey", "nation", "balance")


NAMES = """'/drop/' || CASE o_orderstatus WHEN 'F' THEN 'site_' || strftime(o_orderdate, '%Y%m%d') || '_120001.csv'
  WHEN 'O' THEN 'site_' || strftime(o_orderdate, '%Y%m') || CASE WHEN o_orderpriority = '5-LOW' THEN '31' ELSE '' END || '.csv'
  ELSE CASE WHEN o_orderpriority = '1-URGENT' THEN 'users.csv' ELSE 'users_' || strftime(o_orderdate, '%Y_%m_%d') || '.tar.gz'
  END END"""


def named_orders(spark, folder):
    d, s, p = F.col("o_orderdate"), F.col("o_orderstatus"), F.col("o_orderpriority")
    name = (F.when(s == "F", F.concat(F.lit("site_"), F.date_format(d, "yyyyMMdd"), F.lit("_120001.csv")))
            .when(s == "O", F.concat(F.lit("site_"), F.date_format(d, "yyyyMM"),
                                     F.when(p == "5-LOW", "31").otherwise(""), F.lit(".csv")))
            .when(p == "1-URGENT", "users.csv")
            .otherwise(F.concat(F.lit("users_"), F.date_format(d, "yyyy_MM_dd"), F.lit(".tar.gz"))))
    return table(spark, folder, "orders").select(
        "o_orderkey", F.concat(F.lit("/drop/"), name).alias("path"), F.col("o_custkey").alias("length"))


@query(rf"""WITH n AS (SELECT o_orderkey, {NAMES} AS path FROM orders),
    d AS (SELECT o_orderkey, path, regexp_replace(path, '(\d{{4}})_(\d{{2}})_(\d{{2}})', '\1\2\3') AS p FROM n)
    SELECT o_orderkey, regexp_replace(regexp_extract(path, '[^/]*$'), '\.[^.]*$', '') AS stem,
    try_cast(nullif(regexp_extract(p, '(\d{{4}})\d{{2}}', 1), '') AS INTEGER) AS yyyy,
    try_cast(nullif(regexp_extract(p, '\d{{4}}(\d{{2}})', 1), '') AS INTEGER) AS mm,
    try_cast(nullif(regexp_extract(p, '\d{{6}}(\d{{2}})', 1), '') AS INTEGER) AS dd,
    try_cast(nullif(regexp_extract(p, '\d{{8}}_(\d{{2}})\d{{4}}', 1), '') AS INTEGER) AS hh,
    try_cast(nullif(regexp_extract(p, '\d{{8}}_\d{{2}}(\d{{2}})\d{{2}}', 1), '') AS INTEGER) AS mi,
    try_cast(nullif(regexp_extract(p, '\d{{8}}_\d{{4}}(\d{{2}})', 1), '') AS INTEGER) AS ss FROM d""")
def filename_parts(spark, folder):
    n = named_orders(spark, folder)
    return n.select("o_orderkey", files.stem(F.col("path")).alias("stem"),
                    files.name_parts(F.col("path")).alias("p")).select("o_orderkey", "stem", "p.*")


@query(f"""WITH n AS (SELECT o_orderkey, {NAMES} AS path, o_orderstatus AS s, o_orderpriority AS p, o_orderdate AS d
    FROM orders) SELECT o_orderkey, CASE WHEN s = 'F' OR (s = 'P' AND p <> '1-URGENT') THEN CAST(d AS DATE)
    WHEN s = 'P' THEN NULL WHEN p <> '5-LOW' THEN CAST(date_trunc('month', d) AS DATE)
    ELSE CAST(try_strptime(strftime(d, '%Y%m') || '31', '%Y%m%d') AS DATE) END AS file_date,
    CASE WHEN s = 'P' AND p = '1-URGENT' THEN 'Missing/invalid date pattern in filename'
    WHEN s = 'O' AND p = '5-LOW' AND try_strptime(strftime(d, '%Y%m') || '31', '%Y%m%d') IS NULL
    THEN 'INVALID DATE in filename' END AS error_message FROM n""")
def filename_validate(spark, folder):
    n = named_orders(spark, folder)
    return n.select("o_orderkey", files.name_date(F.col("path")).alias("file_date"),
                    files.name_error(F.col("path")).alias("error_message"))
