"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import suite  # noqa: E402
from suite.base import table  # noqa: E402
from tidegate.rules import TableRule  # noqa: E402
from tidegate.session import fresh_path, local_session  # noqa: E402
from tidegate.sources.delimited import read_delimited  # noqa: E402

HEADLINE = ("governed_orders", "load_merge", "load_history", "csv_first_line", "csv_quoted_multiline", "fixed_width",
            "line_id", "zip_scan", "file_discovery", "date_parse", "date_errors", "safe_cast_types", "decimal_comma",
            "dq_dup_key", "dq_check_file", "dq_type_mismatch", "action_ict", "error_summary", "newest_per_key",
            "mode_merge", "mode_merge_small_batch", "mode_key_replace_composite", "partitioned_write", "agg_group",
            "row_number", "silver", "gold", "recent_errors")
NAMES = ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"]


def csv_read_count(spark, folder):
    """Write lineitem as CSV beforehand; the timed part reads and counts it."""
    path = fresh_path(spark, "bench")
    table(spark, folder, "lineitem").select(*NAMES).write.option("header", True).csv(path)

    def read():
        df = read_delimited(spark, path, TableRule("lineitem", header="FIRST LINE"), NAMES, lineage=False)
        return df.count()
    return read


def best(run, times=2):
    took = []
    for _ in range(times):
        began = time.perf_counter()
        run()
        took.append(time.perf_counter() - began)
    return round(min(took), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, int(cores) if cores.isdigit() else 8)
    queries = suite.queries()
    seconds = {"csv_read_count": best(csv_read_count(spark, folder))}
    for name in HEADLINE:
        seconds[name] = best(lambda: queries[name](spark, folder).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "total headline time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
