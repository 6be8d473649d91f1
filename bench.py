"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

``silver_build`` and ``gold_build`` write the layers anew from the driver's
tables. The queries on gold then read those files, as they would in use; all
others start from the driver's tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.spark_queries import QUERIES  # noqa: E402
from registry.tables import Lake  # noqa: E402
from sensorlake.session import build_session  # noqa: E402

HEADLINE = [
    # on gold
    "avg_by_sensor", "readings_per_hour", "count_by_level", "avg_by_type", "critical_events",
    "monthly_summary", "alerts_by_type", "daily_summary",
    "dash_by_type", "level_share", "dash_avg_by_sensor", "dash_trend", "readings_per_hour_fanout",
    # on raw readings
    "avg_by_sensor_raw", "readings_by_hour_of_day", "count_by_raw_level", "avg_by_type_raw", "critical_events_raw",
    # cleaning, quality, dimensions, alerts
    "silver_clean", "quality_nulls", "quality_describe", "fact_readings", "sensor_dim",
    "scd2_build", "scd2_merge", "join_as_of", "active_sensors", "assign_sensor_even", "anomaly_episodes", "anomaly_episodes_positions", "rollup_day", "rollup_turbine",
    "clustered_fact_scan", "stream_alerts", "stream_hourly",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")

    # start the JVM's compiler on the smallest query, outside the clock
    run(QUERIES["readings_by_hour_of_day"](spark, sf_dir))

    # every figure is the second of two runs, when classes are loaded and code is generated
    seconds = {}
    for folder in (Lake(spark, sf_dir), Lake.of(spark, sf_dir)):
        folder.bronze()
        seconds["silver_build"] = timed(folder.silver)
        seconds["gold_build"] = timed(lambda: folder.gold("fact_readings"))
        # what the joins and the view of the versions read: listings, and change points after two merges
        folder.versions()
        seconds["version_slices"] = timed(folder.version_slices)
        seconds["service_slices"] = timed(folder.service_slices)
        seconds["service_index"] = timed(folder.service_index)
        folder.first_points()
        seconds["points_merge"] = timed(folder.merged_points)
    # layers and tables that several queries read are written before those are timed
    folder.long_gold("fact_readings")
    folder.dim_time_reading()
    folder.calendar()
    for name in HEADLINE:
        for _ in range(2):
            seconds[name] = timed(lambda: run(QUERIES[name](spark, sf_dir)))
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(seconds.values()), 4), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
