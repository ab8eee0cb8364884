"""Benchmark: headline queries end to end from the source Parquet files.

Every query starts from an empty workspace, so its time includes the raw join, cleaning, outlier cut, customer summary and
scores it needs, not only the last step. One JSON line goes to standard output.
"""

from __future__ import annotations

import json
import os
import sys
import time

from patronscope.plans.catalog import QUERIES
from patronscope.plans.workspace import forget, workspace
from patronscope.session import build_session

HEADLINE = (
    "segment_summary", "dq_raw_report", "cleaning_funnel", "clean_sql_rules", "customer_summary", "rfm_segments", "rfm_ranks",
    "pareto", "product_affinity", "purchase_gaps", "transaction_export", "monthly_activity", "segment_box", "retention_matrix",
    "clv_summary", "clv_tiers", "ab_bonferroni", "action_priority", "iforest_score",
    "kmeans_fit", "knn_distance", "bgnbd_fit", "gamma_gamma_fit", "cust_anomaly_flag", "stream_revenue",
)


def run(spark, folder: str, name: str) -> float:
    forget(spark, folder)
    start = time.perf_counter()
    QUERIES[name](workspace(spark, folder)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", int(cpus), spark__driver__memory="8g",
                          spark__sql__files__openCostInBytes="1048576")
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, folder, "segment_summary")  # warm-up: class loading and code generation
    seconds = {name: round(run(spark, folder, name), 3) for name in names}
    print(json.dumps({
        "metric": "headline queries end to end", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
