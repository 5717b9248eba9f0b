"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from invoicelake.plans.registry import all_queries  # noqa: E402
from invoicelake.plans.workspace import Workspace  # noqa: E402
from invoicelake.session import local_session  # noqa: E402

HEADLINES = [
    "label_rows", "silver", "quarantine", "reject_report", "monthly_kpis", "product_performance",
    "customer_features", "churn_snapshot", "churned_anti", "rfm_segments", "segment_rollup",
    "recency_auc", "top_decile", "risk_by_rate", "reversal_pairs", "leakage_adjusted",
    "order_entry_check", "calendar_kpis", "bi_overview", "bi_yoy", "bi_cancel_rate_table",
    "q_leakage_pct", "q_top_foreign", "q_best_month", "call_list_by_rate", "winback_list_by_rate",
    "screen_queries", "result_match", "model_eval",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    # standard output carries the JSON line only
    with contextlib.redirect_stdout(sys.stderr):
        spark = local_session("bench", cores=cores, spark__sql__shuffle__partitions=cores)
        spark.sparkContext.setLogLevel("ERROR")
        queries, seconds = all_queries(), {}

        def timed(name: str, work) -> None:
            begin = time.perf_counter()
            work()
            seconds[name] = round(time.perf_counter() - begin, 3)

        ws = Workspace.of(spark, folder)
        # the hand-over tables every query shares are timed once, under their own names
        timed("load_bronze", lambda: ws.bronze)
        timed("load_lines", lambda: ws.lines)
        for name in HEADLINES:
            timed(name, lambda: queries[name](spark, folder).write.format("noop").mode("overwrite").save())
        spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf"), "cpus": int(cores),
    }))


if __name__ == "__main__":
    main()
