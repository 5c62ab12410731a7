"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_QUERIES  comma list of names, or "all" (default: the headline queries)
BENCH_REPEAT   timed runs per query after one warm-up; the best counts (default 2)
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.catalog import registered  # noqa: E402
from tidemark.session import build_session  # noqa: E402
from tidemark.sources.scratch import drop_scratch  # noqa: E402

HEADLINE = ["sales_fact", "sales_raw_to_fact", "receivables_ledger", "receivables_by_order", "order_balance",
            "receivables_due_dates", "overdue_classes", "win_rolling_due_date", "stock_position", "stock_cover",
            "run_rate", "programme_progress", "version_history", "attribute_changes", "snapshot_soft_delete",
            "visit_compliance", "lead_times", "plan_unpivot", "access_matrix", "note_consolidation",
            "discount_lines", "customer_master", "upsert", "merge_partial_update", "window_replace", "sync_table",
            "sync_stream_upsert", "join_inner_star", "join_range", "agg_cond_pivot", "win_running", "word_count"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not wanted else list(registered) if wanted == "all" else wanted.split(",")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = None
        for i in range(repeat + 1):
            start = time.perf_counter()
            registered[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if i or not repeat:
                best = took if best is None else min(best, took)
        drop_scratch(spark)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
