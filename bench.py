"""Time the headline queries and print one JSON line.

Each query's result is written to a no-op sink, so that all of it is computed. The first of the runs
warms up code generation; the best of the others counts.
"""

from __future__ import annotations

import json
import os
import time

from contract.queries import registry
from tarifa.session import build_session

HEADLINE = [
    "stg_prices", "price_changes", "current_prices", "station_dim", "prices_in_force", "daily_medians",
    "motorway_gap", "gap_summary", "raw_price_stats", "xml_prices", "raw_write", "export_stations",
    "price_changes_years", "prices_in_force_years", "daily_medians_years", "dq_medians_station_bound",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
    reports = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    total = round(sum(seconds.values()), 3)
    line = {
        "metric": "total time of the headline queries",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "reports": reports,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
