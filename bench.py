"""Time the headline queries: one warm-up, then the median of the runs; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all), BENCH_RUNS (default 3), and names as arguments.
One whole load comes first and is not timed: it renders the raw files and compiles what the layers share. Then each query is timed
alike: run once untimed, then until it has been timed BENCH_RUNS times or has taken six seconds. A query whose untimed run took
six seconds is one over those layers, and that run counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from garimpo.session import build_session, tune
from workload import ALL

HEADLINE = (
    "seller_month_mart consolidate_duplicates version_keys canonical_labels strict_casts parse_dates format_phones "
    "repair_shifted conflict_evidence conformed_dimension grain_conflicts grain_accepted mapped_dimension_check "
    "shared_dimension calendar star_fact fact_contract financial_mart abc_curve running_totals funnel_mart "
    "aggregate_functions row_contracts trace trace_with_held orphans reconcile_totals raw_reconcile measures_kpi "
    "measures_by_month filtered_measures product_series_long silver_sales silver_leads silver_positions "
    "identity_quarantine dealership_sales_fact dealership_seller_mart dealership_product_mart dealership_funnel_mart "
    "dealership_proofs dashboard_kpis dealership_load order_positions release_switch counted_write broken_proofs"
).split()
LAYERS = [n for n in HEADLINE if n.startswith(("silver_", "identity_", "dealership_", "dashboard_", "broken_", "repair_"))]


def run(spark, sf_dir: str, query) -> float:
    start = time.time()
    query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.time() - start


def timed(spark, sf_dir: str, query, runs: int) -> float:
    first = run(spark, sf_dir, query)
    spent: list[float] = [first] if first > 6 else []
    while not spent or (len(spent) < runs and sum(spent) < 6):
        spent.append(run(spark, sf_dir, query))
    return round(statistics.median(spent), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    by_name = {q.name: q for q in ALL}
    spark = tune(build_session("bench", cpus))
    warm_up = run(spark, sf_dir, by_name["dealership_load"]) if set(wanted) & set(LAYERS) else 0.0
    times = {}
    for name in wanted:
        times[name] = timed(spark, sf_dir, by_name[name], runs)
        print(name, times[name], file=sys.stderr, flush=True)
    line = {
        "metric": f"sum of {len(times)} queries, warm, median of up to {runs}, local[{cpus}]",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "warm_up": round(warm_up, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
