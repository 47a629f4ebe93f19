"""Time the headline queries and print one JSON line.

Each query runs twice, planning included: ``first_run`` holds the cold times (class
loading and code generation), ``queries`` the second ones, whose sum is the value.
A boosted fit of 500 rounds takes minutes and its second run would only share the fitted
model; one fit is timed as ``fit_gbt`` beside the sum, and ``fit_leafwise`` is one of as many
rounds grown best leaf first. ``BENCH_FIT=0`` leaves both out.
"""

from __future__ import annotations

import json
import os
import time

from mixlab.plans.catalog import QUERIES
from mixlab.session import local_session

HEADLINE = [
    "daily_sales",
    "daily_sales_distinct",
    "sales_by_product",
    "customer_frequency",
    "describe",
    "quartiles",
    "iqr_outliers_by_country",
    "fill_median",
    "interpolate",
    "rolling_features",
    "channel_transform",
    "build_panel",
    "correlation_matrix",
    "train_linear",
    "param_search",
    "channel_contributions",
    "allocate_budget",
    "compare_scenarios",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "mixlab-bench", **{"spark.sql.shuffle.partitions": cores})
    spark.range(1000).selectExpr("sum(id)").collect()
    first, seconds = {}, {}
    for name in HEADLINE:
        for record in (first, seconds):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            record[name] = round(time.perf_counter() - start, 3)
    extra = {}
    if os.environ.get("BENCH_FIT", "1") != "0":
        for name, fit in (("fit_leafwise", "train_leafwise"), ("fit_gbt", "train_gbt")):
            start = time.perf_counter()
            QUERIES[fit](spark, folder).write.format("noop").mode("overwrite").save()
            extra[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": scale,
                "first_run": first,
                **extra,
            }
        )
    )


if __name__ == "__main__":
    main()
