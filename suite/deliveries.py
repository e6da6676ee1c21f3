"""Deliveries that go wrong in part: what a load keeps, refuses and logs."""

from __future__ import annotations

import dataclasses
from datetime import datetime
from itertools import permutations
from unittest import mock

from pyspark.sql import functions as F

from suite.base import collector, decimal_text, table
from suite.loads import PLAIN
from tidegate.operators import modes
from tidegate.operators.aggregates import merged_quantiles, numeric_profile, quantile_sketches, row_numbers
from tidegate.operators.cleanse import cleanse
from tidegate.plans.intake import Layout, load_table, run
from tidegate.rules import ColumnRule, TableRule, for_table, load_column_rules, load_table_rules, rules_frame
from tidegate.session import fresh_path, staged, tune
from tidegate.sinks.tables import CurrentTable, partition_types, read_table, stamp
from tidegate.sources.delimited import read_delimited

SUITE, query = collector()

AT = datetime(2025, 12, 1, 12, 0, 1)
RULES = [ColumnRule("orderkey", "orders", field_type="LONG"), ColumnRule("price", "orders", field_type="DECIMAL", decimal_precision=12, decimal_scale=2),
         ColumnRule("status", "orders")]
PRICED = "SELECT o_orderkey AS orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS price, o_orderstatus AS status FROM orders"


def priced(spark, folder):
    return table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("orderkey"), decimal_text("o_totalprice").alias("price"),
                                                 F.col("o_orderstatus").alias("status"))


def fresh_layout(spark, inbox=""):
    return Layout(inbox=inbox, root=fresh_path(spark, "lake"))


def written(df, path, header=True):
    df.write.mode("append").options(sep=";", header=header, **PLAIN).csv(path)
    return path


def named(spark, df, prefix, header=True):
    """A folder with one CSV file per value of ``part``, written in parallel; the value ends the file's name."""
    path = fresh_path(spark, "inbox")
    tune(spark)
    df.repartition("part").write.options(sep=";", header=header, **PLAIN).partitionBy("part").csv(path)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in system.listStatus(root):
        number = folder.getPath().getName().rpartition("=")[2]
        for file in system.listStatus(folder.getPath()) if folder.isDirectory() else ():
            system.rename(file.getPath(), spark._jvm.org.apache.hadoop.fs.Path(root, f"{prefix}{number:0>6}.csv"))
    return path


def numbered(spark, df, prefix):
    """A folder with one CSV file per task, so that files become more, not longer, with the rows; a number ends the file's name."""
    path = written(df, fresh_path(spark, "inbox"))
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files = [file.getPath() for file in system.listStatus(root) if file.getPath().getName().startswith("part-")]
    for number, file in enumerate(files):
        system.rename(file, spark._jvm.org.apache.hadoop.fs.Path(root, f"{prefix}{number:0>6}.csv"))
    return path


def in_parts(df, parts=5):
    return df.withColumn("part", F.col("orderkey").cast("long") % parts)


def rule(mode="APPEND", **more):
    return TableRule("orders", **({"header": "FIRST LINE", "ingestion_mode": mode, "delimiter": ";", "merge_files": True} | more))


@query(PRICED)
def load_rejected_snapshot(spark, folder):
    """A good snapshot, then one whose files hold too many corrupt lines: the first stays."""
    layout, bare = fresh_layout(spark), rule("FULL_SNAPSHOT", header=None)
    load_table(spark, bare, RULES, layout, AT, written(priced(spark, folder), fresh_path(spark, "delivery"), False))
    load_table(spark, bare, RULES, layout, AT, written(priced(spark, folder).select("orderkey"), fresh_path(spark, "delivery"), False))
    return CurrentTable(spark, layout.table(bare, "last")).read().select("orderkey", "price", "status")


@query(f"{PRICED} WHERE FALSE")
def load_empty_state(spark, folder):
    """A snapshot of which every row is refused leaves an empty table with its columns."""
    layout = fresh_layout(spark)
    strict = [RULES[0], ColumnRule("price", "orders", field_type="DECIMAL", decimal_precision=12, decimal_scale=2, is_nullable=False, error_action="REJECT"), RULES[2]]
    unpriced = priced(spark, folder).withColumn("price", F.lit("unknown"))
    load_table(spark, rule("FULL_SNAPSHOT"), strict, layout, AT, written(unpriced, fresh_path(spark, "delivery")))
    return CurrentTable(spark, layout.table(rule(), "last")).read().select("orderkey", "price", "status")


@query(f"{PRICED} WHERE o_orderstatus IN ('F', 'O')")
def load_mixed_headers(spark, folder):
    """Files with all columns in every order, and without one: the last are refused, the others loaded by one scan."""
    layout, source, df = fresh_layout(spark), fresh_path(spark, "delivery"), priced(spark, folder)
    good = df.filter("status <> 'P'")
    for i, order in enumerate(permutations(df.columns)):
        written(good.filter(F.col("orderkey").cast("long") % 6 == i).select(*order), source)
    written(df.filter("status = 'P'").select("orderkey", "status"), source)
    load_table(spark, rule(), RULES, layout, AT, source)
    return read_table(spark, layout.table(rule(), "all")).select("orderkey", "price", "status")


@query(f"{PRICED} WHERE o_orderstatus <> 'P'")
def load_header_width(spark, folder):
    """Under HEADER USE a file whose first line has another width is refused."""
    layout, source, df = fresh_layout(spark), fresh_path(spark, "delivery"), priced(spark, folder)
    written(df.filter("status <> 'P'").toDF("a", "b", "c"), source)
    written(df.filter("status = 'P'").select("orderkey", "status"), source)
    load_table(spark, rule(header="HEADER USE"), RULES, layout, AT, source)
    return read_table(spark, layout.table(rule(), "all")).select("orderkey", "price", "status")


@query("SELECT CAST(o_orderkey AS VARCHAR) || ';' || o_orderstatus AS record FROM orders WHERE o_orderstatus = 'P'")
def load_quarantine(spark, folder):
    """Lines with too few fields, as received."""
    layout, source, df = fresh_layout(spark), fresh_path(spark, "delivery"), priced(spark, folder)
    whole = F.when(F.col("status") == "P", F.concat_ws(";", "orderkey", "status")).otherwise(F.concat_ws(";", *df.columns))
    df.select(whole.alias("value")).write.text(source)
    load_table(spark, rule(header=None, reject_tolerance="100%", invalid_lines_generate=True), RULES, layout, AT, source)
    return spark.read.parquet(layout.quarantine("orders")).select("record")


@query("SELECT o_orderkey AS orderkey, 'INVALID_ROW' AS error_type FROM orders WHERE o_orderpriority = '5-LOW'")
def load_invalid_rows(spark, folder):
    """Rows with more nulls in required columns than allowed are logged whole."""
    layout = fresh_layout(spark)
    low = F.col("o_orderpriority") == "5-LOW"
    raw = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("orderkey"),
                                                F.when(~low, decimal_text("o_totalprice")).alias("price"), F.when(~low, F.col("o_orderstatus")).alias("status"))
    strict = [RULES[0], ColumnRule("price", "orders", field_type="DOUBLE", is_nullable=False), ColumnRule("status", "orders", is_nullable=False)]
    load_table(spark, rule(), strict, layout, AT, written(raw, fresh_path(spark, "delivery")))
    log = read_table(spark, layout.quality_log).filter("error_type = 'INVALID_ROW'")
    return log.select(F.get_json_object("raw_value", "$.orderkey").cast("long").alias("orderkey"), "error_type")


TIMED = "orders_<yyyy><mm><dd>_<hhmmss>.csv"


@query("""SELECT 'badsep' AS table_name, 'FAILED' AS status, CAST(1 AS BIGINT) AS files, CAST(0 AS BIGINT) AS row_count UNION ALL
    SELECT 'nokeys', 'FAILED', 1, 0 UNION ALL SELECT 'none', 'FAILED', 1, 0 UNION ALL SELECT 'sheet', 'FAILED', 1, 0 UNION ALL
    SELECT 'orders', 'SUCCESS', count(DISTINCT o_orderkey % 5), count(*) FROM orders""")
def run_log(spark, folder):
    """Every table of a run has its rows, whatever befalls the others."""
    inbox = named(spark, in_parts(priced(spark, folder)), "orders_20251201_")
    pattern = {"filename_pattern": TIMED, "header": "FIRST LINE", "delimiter": ";"}
    tables = [TableRule("nokeys", ingestion_mode="MERGE", **pattern), TableRule("badsep", **(pattern | {"delimiter": "ab"})),
              TableRule("sheet", input_format="excel", **pattern), TableRule("none", filename_pattern="none_<yyyy>.csv"), rule(filename_pattern=TIMED)]
    columns = [ColumnRule(r.column_name, t, r.field_type) for t in ("nokeys", "badsep", "none", "sheet") for r in RULES] + RULES
    log = run(spark, tables, columns, fresh_layout(spark, inbox), AT)
    return log.groupBy("table_name", "status").agg(F.count("*").alias("files"), F.sum("row_count").alias("row_count"))


@query("""SELECT o_orderkey AS orderkey, 'new orders+_20251130_' || lpad(CAST(o_orderkey % 5 AS VARCHAR), 6, '0') AS "FILE_NAME_RECEIVED",
    TIMESTAMP '2025-12-01 12:00:01' AS at, CAST(2025 AS INTEGER) AS yyyy, CAST(11 AS INTEGER) AS mm, CAST(30 AS INTEGER) AS dd FROM orders""")
def load_audit(spark, folder):
    """Audit and partition columns of files whose names hold a blank and a plus sign."""
    layout = fresh_layout(spark, named(spark, in_parts(priced(spark, folder)), "new orders+_20251130_"))
    loaded = rule(filename_pattern="new orders+_<yyyy><mm><dd>_<hhmmss>.csv")
    load_table(spark, loaded, RULES, layout, AT)
    stored = read_table(spark, layout.table(loaded, "all"))
    return stored.select("orderkey", "FILE_NAME_RECEIVED", F.col("FILE_PROCESS_DATE").cast("timestamp_ntz").alias("at"), "yyyy", "mm", "dd")


@query("""SELECT 'FILE_REJECTED' AS error_type, 'INVALID DATE in filename' AS error_message, 'orders_20251399_' ||
    lpad(CAST(o_orderkey % 5 AS VARCHAR), 6, '0') || '.csv' AS raw_value, TRUE AS has_uri, CAST(1 AS BIGINT) AS n FROM orders GROUP BY o_orderkey % 5""")
def load_bad_name(spark, folder):
    """File names with an impossible date are refused; the log holds the names and the places."""
    layout = fresh_layout(spark, named(spark, in_parts(priced(spark, folder)), "orders_20251399_"))
    load_table(spark, rule(filename_pattern=TIMED), RULES, layout, AT)
    log = read_table(spark, layout.quality_log)
    return log.groupBy("error_type", "error_message", "raw_value", F.col("uri").isNotNull().alias("has_uri")).agg(F.count("*").alias("n"))


@query(PRICED)
def csv_deprecated(spark, folder):
    """The old name of the plain format."""
    layout, old = fresh_layout(spark), rule(input_format="csv_deprecated")
    load_table(spark, old, RULES, layout, AT, written(priced(spark, folder), fresh_path(spark, "delivery")))
    return read_table(spark, layout.table(old, "all")).select("orderkey", "price", "status")


@query("""SELECT 'first' AS load, 'SUCCESS' AS status, '0' AS error_message, count(*) AS row_count FROM orders UNION ALL
    SELECT 'second', 'FAILED', 'Empty file for orders_<yyyy><mm><dd>_<hhmmss>.csv', 0""")
def empty_files(spark, folder):
    """An empty file among the others stops a table that does not ignore them, and is nothing to one that does."""
    inbox = numbered(spark, priced(spark, folder), "orders_20251201_")
    nothing = spark._jvm.org.apache.hadoop.fs.Path(f"{inbox}/orders_20251202_000000.csv")
    nothing.getFileSystem(spark._jsc.hadoopConfiguration()).create(nothing).close()
    logs = [load_table(spark, rule(filename_pattern=TIMED, ignore_empty=ignore), RULES, fresh_layout(spark, inbox), AT).withColumn("load", F.lit(name))
            for name, ignore in (("first", True), ("second", False))]
    return logs[0].unionByName(logs[1]).groupBy("load", "status", "error_message").agg(F.sum("row_count").cast("long").alias("row_count"))


def two_parts(spark, folder):
    """Two deliveries of orders."""
    df = priced(spark, folder)
    even = F.col("orderkey").cast("long") % 2 == 0
    return [written(df.filter(part), fresh_path(spark, "delivery")) for part in (even, ~even)]


@query(f"""SELECT 'all' AS place, orderkey, price, status FROM ({PRICED}) UNION ALL SELECT 'last', orderkey, price, status FROM ({PRICED})""")
def load_retry(spark, folder):
    """A second load fails when history is already written; repeated, it adds its rows once."""
    layout, keyed = fresh_layout(spark), [ColumnRule("orderkey", "orders", field_type="LONG", is_merge_key=True), *RULES[1:]]
    merge, (first, second) = rule("FULL_KEY_REPLACE"), two_parts(spark, folder)
    load_table(spark, merge, keyed, layout, AT, first)
    with mock.patch.object(CurrentTable, "change", side_effect=OSError("no space left")):
        lost = load_table(spark, merge, keyed, layout, AT, second).first()
    assert lost["status"] == "FAILED" and lost["row_count"] == 0
    load_table(spark, merge, keyed, layout, AT, second)
    both = [read_table(spark, layout.table(merge, s)).select(F.lit(s).alias("place"), "orderkey", "price", "status") for s in ("all", "last")]
    return both[0].unionByName(both[1])


@query(PRICED)
def load_twice(spark, folder):
    """Files that a load has taken are left out by the next one."""
    layout, inbox = dataclasses.replace(fresh_layout(spark), once=True), fresh_path(spark, "inbox")
    df = priced(spark, folder)
    for part in ("status = 'F'", "status <> 'F'", "false"):
        written(df.filter(part), inbox)
        load_table(spark, rule(), RULES, layout, AT, inbox)
    return read_table(spark, layout.table(rule(), "all")).select("orderkey", "price", "status")


@query("SELECT o_orderkey AS orderkey, CAST(o_custkey % 100 AS DOUBLE) + CASE WHEN o_orderkey % 2 = 1 THEN 0.5 ELSE 0 END AS price, o_orderstatus AS status FROM orders")
def append_widen(spark, folder):
    """A column's type grows from INT to DOUBLE: rows written earlier are read under the new type."""
    layout = fresh_layout(spark)
    o = table(spark, folder, "orders")
    for odd, kind in ((0, "INTEGER"), (1, "DOUBLE")):
        price = (F.col("o_custkey") % 100).cast("string")
        raw = o.filter(F.col("o_orderkey") % 2 == odd).select(F.col("o_orderkey").cast("string").alias("orderkey"),
                                                              (F.concat(price, F.lit(".5")) if odd else price).alias("price"), F.col("o_orderstatus").alias("status"))
        load_table(spark, rule(), [RULES[0], ColumnRule("price", "orders", field_type=kind), RULES[2]], layout, AT, written(raw, fresh_path(spark, "delivery")))
    return read_table(spark, layout.table(rule(), "all")).select("orderkey", "price", "status")


@query(f"""SELECT 'FAILED' AS outcome, 'TypeConflict: Column orderkey is string, the stored one bigint' AS error_message, orderkey, price, status
    FROM ({PRICED}) WHERE orderkey % 2 = 0""")
def append_conflict(spark, folder):
    """A load whose column types do not go with the stored ones fails before it writes; the table stays as it was."""
    layout, (first, second) = fresh_layout(spark), two_parts(spark, folder)
    load_table(spark, rule(), RULES, layout, AT, first)
    log = load_table(spark, rule(), [ColumnRule("orderkey", "orders"), *RULES[1:]], layout, AT, second).first()
    stored = read_table(spark, layout.table(rule(), "all"))
    return stored.select(F.lit(log["status"]).alias("outcome"), F.lit(log["error_message"]).alias("error_message"), "orderkey", "price", "status")


@query("""SELECT o_orderkey AS orderkey, '2025' AS yyyy, '12' AS mm, CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '2' END AS dd FROM orders""")
def partition_type_kept(spark, folder):
    """Partition columns that a table holds as text stay text, whatever a later append brings."""
    keys = table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"))
    current = CurrentTable(spark, fresh_path(spark, "orders_last"))
    for odd, kinds in ((0, {"yyyy": "string", "mm": "string", "dd": "string"}), (1, None)):
        batch = stamp(keys.filter(F.col("orderkey") % 2 == odd), {"yyyy": 2025, "mm": 12, "dd": 1 + odd}, None, AT, kinds or partition_types(current.columns()))
        current.append(batch)
    return current.read().select("orderkey", "yyyy", "mm", "dd")


@query("SELECT o_orderkey AS orderkey, TRUE AS within_run FROM orders")
def process_time(spark, folder):
    """Without a given time rows are stamped with that of their run."""
    began = datetime.now()
    rows = staged(stamp(table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"))), "stamped")
    ended = datetime.now()
    # The session's time zone does not matter to moments.
    moment = F.unix_micros("FILE_PROCESS_DATE") / 1e6
    return rows.select("orderkey", moment.between(began.timestamp() - 0.001, ended.timestamp()).alias("within_run"))


@query("""SELECT p_partkey, p_partkey % 3 <> 0 AS listed, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS p_name,
    CASE WHEN p_partkey % 3 = 0 THEN 'INVALID_ENUM' END AS error_type FROM part""")
def check_enum_table(spark, folder):
    """Names checked against a stored list of many thousand values."""
    names = table(spark, folder, "part").select(F.concat("p_name", F.lit(" "), "p_partkey").alias("p_name"), "p_partkey")
    path = fresh_path(spark, "names")
    names.filter("p_partkey % 3 <> 0").select("p_name").write.parquet(path)
    cleansed = staged(cleanse(names, [ColumnRule("p_name", enumeration_table=path)], trim=True), "cleansed")
    error = F.col("_errors")[0]["error_type"]
    plain = F.regexp_replace("p_name", " [0-9]+$", "")
    return cleansed.select("p_partkey", F.col("p_name").isNotNull().alias("listed"), plain.alias("p_name"), error.alias("error_type"))


@query("""SELECT event_type, count(value) AS value_count, TRUE AS within_bound FROM events WHERE value IS NOT NULL GROUP BY event_type""")
def median_sketch(spark, folder):
    """Sketches per day, stored and merged: the ranks of the quantiles read from them are off by a small part of the rows at most."""
    e = table(spark, folder, "events").filter("value IS NOT NULL")
    daily = staged(quantile_sketches(e, "value", ["event_type", F.to_date("ts").alias("day")]), "sketches")
    found = staged(merged_quantiles(daily, ["event_type"], [0.25, 0.5, 0.9]), "quantiles")
    ranks = e.join(F.broadcast(found), "event_type").groupBy("event_type", "value_count").agg(*[
        F.struct(F.count_if(F.col("value") < F.col(q)).alias("below"), F.count_if(F.col("value") <= F.col(q)).alias("upto")).alias(q) for q in ("q25", "q50", "q90")])
    slack, fit = F.col("value_count") / 250 + 1, F.lit(True)
    for q, share in (("q25", 0.25), ("q50", 0.5), ("q90", 0.9)):
        place = F.col("value_count") * share
        fit = fit & (F.col(f"{q}.below") <= place + slack) & (F.col(f"{q}.upto") >= place - slack)
    return ranks.select("event_type", "value_count", fit.alias("within_bound"))


@query("""SELECT event_id, CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS n FROM events""")
def row_number_single_group(spark, folder):
    """All rows are one group: numbered by ranges, in no single task."""
    e = table(spark, folder, "events").select("event_id", "ts")
    return row_numbers(e, [], [F.col("ts"), F.col("event_id")], name="n").select("event_id", "n")


@query(PRICED)
def rules_from_csv(spark, folder):
    """Both rule tables read from CSV files; the column rules of other tables do not matter."""
    stray = [ColumnRule("orderkey", "other", field_type="DATE")]
    paths = [fresh_path(spark, "rules") for _ in range(2)]
    rules_frame(spark, [rule()], TableRule).write.option("header", True).csv(paths[0])
    # Without a field order the order of the file counts.
    rules_frame(spark, stray + RULES, ColumnRule).coalesce(1).write.option("header", True).csv(paths[1])
    (loaded,), columns = load_table_rules(spark, paths[0]), load_column_rules(spark, paths[1])
    layout = fresh_layout(spark)
    load_table(spark, loaded, for_table(columns, loaded.table_name), layout, AT, written(priced(spark, folder), fresh_path(spark, "delivery")))
    return read_table(spark, layout.table(loaded, "all")).select("orderkey", "price", "status")


@query("""SELECT o_custkey, o_orderkey, o_totalprice, CAST(CASE WHEN o_orderstatus = 'F' THEN NULL END AS VARCHAR) AS note FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate) = 1""")
def merge_columns(spark, folder):
    """A merge keeps the columns of the target: what the batch lacks is null, what it has beyond them is left out."""
    o = table(spark, folder, "orders")
    state = o.filter("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", F.lit(None).cast("string").alias("note"))
    batch = o.filter("o_orderstatus <> 'F'").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", F.lit("x").alias("beyond"))
    return modes.merge_newest(state, batch, ["o_orderkey"], "o_orderdate").select("o_custkey", "o_orderkey", "o_totalprice", "note")


def read_as(spark, folder, sep, **more):
    """Texts of documents, line breaks and tabs included, written quoted and read by the format for quoted text of several lines."""
    path = fresh_path(spark, "delivery")
    options = {k: v for k, v in more.items() if k == "encoding"}
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.select("doc_id", F.regexp_replace("text", r"[^\x{09}\x{0A}\x{20}-\x{7E}\x{A0}-\x{FF}]", "?").alias("text")) if options else docs
    docs.write.options(sep=sep, quoteAll=True, **PLAIN, **options).csv(path)
    loaded = TableRule("documents", input_format="csv_quote_ml", delimiter=more.get("delimiter", sep), charset=more.get("charset", "UTF-8"))
    return read_delimited(spark, path, loaded, ["doc_id", "text"], lineage=False).select(F.col("doc_id").cast("long").alias("doc_id"), "text")


@query("SELECT doc_id, text FROM documents")
def csv_tab(spark, folder):
    return read_as(spark, folder, "\t")


@query("SELECT doc_id, text FROM documents")
def csv_pipe(spark, folder):
    return read_as(spark, folder, "|")


@query(r"""SELECT doc_id, regexp_replace(text, '[^\x{09}\x{0A}\x{20}-\x{7E}\x{A0}-\x{FF}]', '?', 'g') AS text FROM documents""")
def csv_ansi(spark, folder):
    """Characters the charset cannot hold are written as question marks beforehand."""
    return read_as(spark, folder, ";", encoding="ISO-8859-1", charset="ANSI")


@query("SELECT event_type, TRUE AS within_bound FROM events WHERE value IS NOT NULL GROUP BY event_type")
def median_rank(spark, folder):
    """The approximate median's rank is off by at most one part in the accuracy, in every group."""
    e = table(spark, folder, "events").select("event_type", "value").filter("value IS NOT NULL")
    middle = numeric_profile(e, "value", ["event_type"], accuracy=100).select("event_type", "median", "value_count")
    ranks = e.join(F.broadcast(middle), "event_type").groupBy("event_type", "value_count").agg(
        F.count_if(F.col("value") < F.col("median")).alias("below"), F.count_if(F.col("value") <= F.col("median")).alias("upto"))
    half, slack = F.col("value_count") / 2, F.col("value_count") / 100 + 1
    return ranks.select("event_type", ((F.col("below") <= half + slack) & (F.col("upto") >= half - slack)).alias("within_bound"))
