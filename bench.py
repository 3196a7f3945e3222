"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query runs
once to warm up and once for the clock; results go to the no-op sink, so all rows
and columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from silverlode.plans import catalog  # noqa: E402
from silverlode.session import local_session  # noqa: E402

HEADLINE = [
    "silver_ledger",
    "fact_build",
    "metric_kpi",
    "metric_net_by_month",
    "metric_top_categories",
    "dq_layer_counts",
    "join_fanout_sum",
    "enrich_three_way",
    "agg_month_city",
    "window_running_total",
    "expect_drop",
    "expect_metrics",
    "gold_revenue_by_product",
    "cdc_scd1",
    "cdc_scd2",
    "stream_cdc_scd1",
    "quantiles_exact",
    "silver_customers",
    "features_build",
    "threshold_cost",
    "auc_rank",
    "psi_bands",
    "match_best",
    "text_class_counts",
    "text_extractive_summary",
    "ml_logistic_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, app="bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(run(name), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
