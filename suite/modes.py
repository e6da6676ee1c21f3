"""Ingestion modes over orders: the state of a customer or an order, and a batch that changes it."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import collector, table
from tidegate.operators import modes
from tidegate.session import measured_bytes

SUITE, query = collector()

COLUMNS = ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def sides(spark, folder):
    """Finished orders are the current state, the others arrive as a batch."""
    o = table(spark, folder, "orders").select(*COLUMNS)
    return o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus <> 'F'")


NEWEST = "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"
SIDES = f"""o AS (SELECT {', '.join(COLUMNS)} FROM orders), f AS (SELECT * FROM o WHERE o_orderstatus = 'F'),
    b AS (SELECT * FROM o WHERE o_orderstatus <> 'F')"""


@query(f"WITH {SIDES} SELECT * FROM b")
def mode_snapshot(spark, folder):
    state, batch = sides(spark, folder)
    return modes.apply_mode("FULL_SNAPSHOT", state, batch.withColumn(modes.PROCESS_DATE, F.current_timestamp()))


@query(f"WITH {SIDES} SELECT *, CAST(NULL AS VARCHAR) AS channel FROM f UNION ALL SELECT *, 'late' FROM b")
def mode_append(spark, folder):
    state, batch = sides(spark, folder)
    return modes.apply_mode("DELTA_FROM_FLOW", state, batch.withColumn("channel", F.lit("late")))


@query(f"WITH {SIDES} SELECT * FROM f UNION ALL SELECT * FROM b")
def mode_historized(spark, folder):
    return modes.apply_mode("DELTA_FROM_HISTORIZED", *sides(spark, folder))


@query(f"WITH {SIDES} SELECT * FROM f UNION ALL SELECT * FROM b")
def mode_unknown(spark, folder):
    return modes.apply_mode("SOMETHING_ELSE", *sides(spark, folder))


@query(f"WITH o AS (SELECT {', '.join(COLUMNS)} FROM orders) SELECT * FROM o {NEWEST}")
def newest_per_key(spark, folder):
    o = table(spark, folder, "orders").select(*COLUMNS)
    return modes.newest_per_key(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])


MERGED = f"""{SIDES}, t AS (SELECT * FROM f {NEWEST}), u AS (SELECT * FROM b {NEWEST}),
    m AS (SELECT coalesce(t.o_custkey, u.o_custkey) AS o_custkey,
    CASE WHEN t.o_custkey IS NULL OR u.o_orderdate > t.o_orderdate THEN u.o_orderkey ELSE t.o_orderkey END AS o_orderkey
    FROM t FULL JOIN u ON t.o_custkey = u.o_custkey)
    SELECT o.* FROM o JOIN m ON o.o_orderkey = m.o_orderkey AND o.o_custkey = m.o_custkey"""


def merged(spark, folder, size=None):
    state, batch = sides(spark, folder)
    state = modes.newest_per_key(state, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    batch = batch.withColumn("_line", F.col("o_orderkey"))
    return modes.merge_newest(state, batch, ["o_custkey"], "o_orderdate", ["_line"], size)


@query(f"WITH {MERGED}")
def mode_merge(spark, folder):
    """Latest order per customer, several batch rows per customer."""
    return merged(spark, folder)


@query(f"WITH {MERGED}")
def mode_merge_small_batch(spark, folder):
    """The same with a measured batch, whose size decides on the broadcast."""
    return merged(spark, folder, measured_bytes(sides(spark, folder)[1]))


@query("""WITH c AS (SELECT c_custkey, c_nationkey AS a, c_mktsegment AS b, '15/06/1998' AS since FROM customer),
    l AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1)
    SELECT coalesce(c_custkey, o_custkey) AS c_custkey,
    CASE WHEN d > TIMESTAMP '1998-06-15' OR c_custkey IS NULL THEN -1 ELSE a END AS a,
    CASE WHEN d > TIMESTAMP '1998-06-15' OR c_custkey IS NULL THEN 'ordered' ELSE b END AS b,
    CASE WHEN d > TIMESTAMP '1998-06-15' OR c_custkey IS NULL THEN strftime(d, '%d/%m/%Y') ELSE since END AS since
    FROM c FULL JOIN l ON c_custkey = o_custkey""")
def mode_merge_string_ts(spark, folder):
    """Compare column kept as text: read as a timestamp for the comparison."""
    state = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("a"), F.col("c_mktsegment").alias("b"), F.lit("15/06/1998").alias("since"))
    batch = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.lit(-1).alias("a"), F.lit("ordered").alias("b"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("since"))
    return modes.merge_newest(state, batch, ["c_custkey"], "since")


@query(f"""WITH {SIDES}, n AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey)
    FROM b), t AS (SELECT * FROM f {NEWEST}), u AS (SELECT * FROM n WHERE o_custkey IS NOT NULL {NEWEST}),
    w AS (SELECT t.o_custkey, CASE WHEN u.o_orderdate > t.o_orderdate THEN u.o_orderkey ELSE t.o_orderkey END AS o_orderkey
    FROM t LEFT JOIN u ON t.o_custkey = u.o_custkey UNION ALL
    SELECT o_custkey, o_orderkey FROM u WHERE o_custkey NOT IN (SELECT o_custkey FROM t))
    SELECT o.* FROM o JOIN w ON o.o_orderkey = w.o_orderkey
    UNION ALL SELECT * FROM n WHERE o_custkey IS NULL""")
def mode_merge_null_keys(spark, folder):
    """Batch rows without a key match nothing and are all added."""
    state, batch = sides(spark, folder)
    state = modes.newest_per_key(state, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    batch = batch.withColumns({"_line": F.col("o_orderkey"), "o_custkey": key})
    return modes.merge_newest(state, batch, ["o_custkey"], "o_orderdate", ["_line"])


@query(f"""WITH {SIDES} SELECT * FROM f WHERE o_custkey NOT IN (SELECT o_custkey FROM b) UNION ALL SELECT * FROM b""")
def mode_key_replace(spark, folder):
    state, batch = sides(spark, folder)
    return modes.apply_mode("FULL_KEY_REPLACE", state, batch, ["o_custkey"])


@query("""WITH f AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F'),
    b AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag FROM lineitem WHERE l_linestatus <> 'F')
    SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey = f.l_orderkey
    AND b.l_linenumber = f.l_linenumber) UNION ALL SELECT * FROM b""")
def mode_key_replace_composite(spark, folder):
    names = ["l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"]
    line = table(spark, folder, "lineitem")
    state, batch = line.filter("l_linestatus = 'F'"), line.filter("l_linestatus <> 'F'")
    return modes.apply_mode("FULL_KEY_REPLACE", state.select(names), batch.select(names), names[:2])
