"""Time the headline queries; prints one JSON line.

Each query is run to a no-op sink: once to warm up, then BENCH_RUNS times; the median counts.
Reports that read stored layer tables are timed after those tables exist; ``build_layers`` is the
time to compute and store all of them from the inputs, once.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tripmart.plans import checks
from tripmart.queries import MARTS, SILVER, all_queries
from tripmart.session import local_session
from tripmart.store import Layers

FROM_INPUTS = [
    "mart_daily_demand", "mart_daily_payment_mix", "mart_weather_impact", "mart_zone_demand",
    "fact_trips", "silver_trips", "bronze_trips", "silver_weather", "raw_trip_quality",
    "payment_distribution", "having_duplicates", "unmapped_locations",
]
FROM_LAYERS = [
    "fk_coverage", "fact_quality_profile", "silver_quality_profile", "check_unique_key",
    "check_same_keys", "keyset_diff_one_pass", "mart_quality_profile", "reconcile_zone_demand",
    "cross_mart_demand_zone", "top_zones_fact", "monthly_revenue", "mart_snapshots", "kpi_summary",
]


def suites(layers: Layers) -> dict:
    """The check suites of silver, gold and serving over the stored layers."""
    t = layers.table
    return {
        "silver": lambda: checks.silver_suite(t("silver_trips"), t("bronze_trips")),
        "gold": lambda: checks.gold_suite(
            t("fact_trips"), t("silver_trips"), t("dim_date"), t("dim_zone"), t("dim_weather")
        ),
        "serving": lambda: checks.serving_suite(
            {n: t(n) for n in MARTS}, t("fact_trips"), t("dim_date"), t("dim_zone"), t("dim_weather")
        ),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, os.environ.get("BENCH_MEMORY", "16g"))
    known = all_queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def median(name: str) -> float:
        once(name)
        return round(statistics.median(once(name) for _ in range(runs)), 3)

    def median_of(df) -> float:
        def run() -> float:
            start = time.perf_counter()
            df().write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        run()
        return round(statistics.median(run() for _ in range(runs)), 3)

    once("mart_zone_demand")  # a cold JVM would be charged to the first query
    times = {name: median(name) for name in FROM_INPUTS}
    start = time.perf_counter()
    layers = Layers(spark, folder)
    for name in [*SILVER, "dim_date", "dim_zone", "dim_weather", *MARTS]:
        layers.stored_path(name)
    times["build_layers"] = round(time.perf_counter() - start, 3)
    times.update({name: median(name) for name in FROM_LAYERS})
    times.update({f"suite_{name}": median_of(suite) for name, suite in suites(layers).items()})
    print(
        json.dumps(
            {
                "metric": "sum of query medians, inputs and layers",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
