"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs to the end over its whole input into Spark's no-op sink, twice; the better time counts, so that
class loading and code generation of the first run are left out. Results shared between queries (stream
runs, the batch pipeline) are dropped before each run.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = """
clean_consumption rejected_consumption clean_customers clean_events
daily_region daily_customer monthly_region customer_usage weather_features hourly_region anomalies
latest_reading duplicate_keys running_sum recent_avg_anomaly event_numbers
star_daily top_meters running_daily segment_average tariff_cost weekday_weekend
view_daily view_customer view_latest kpis p_daily p_anomalies
orphan_report quality_suite audit_fk audit_checks
upsert_dim insert_missing consumption_fact readings_fact range_join
stream_clean stream_hours_closed batch_facts
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from meterlake.plans import registry
    from meterlake.session import local_session

    spark = local_session("meterlake-bench", cpus, int(cpus) if cpus.isdigit() else 8, **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            registry._RUNS.clear()
            started = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
