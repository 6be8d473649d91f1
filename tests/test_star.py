from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorlake.operators.ordered import with_position, with_running_total, with_surrogate_key
from sensorlake.operators.star import build_fact, build_sensor_dim, build_time_dim, extend_sensor_dim, star
from sensorlake.plans import jobs, reports
from sensorlake.sources import lake


def silver(spark, rows):
    return spark.createDataFrame(
        rows, "sensor_id int, ts timestamp, reading_id string, sensor_type string, value double, level string")


@pytest.fixture(scope="module")
def two_in_an_hour(spark):
    return silver(spark, [
        (1, datetime(2025, 6, 1, 8, 0), "a", "presion", 90.0, "CRITICA"),
        (2, datetime(2025, 6, 1, 8, 59, 59), "b", "presion", 50.0, "NORMAL"),
        (1, datetime(2025, 6, 2, 9, 0), "c", "presion", 10.0, "NORMAL"),
    ])


def gold(df, grain):
    dim_sensor = build_sensor_dim(df)
    return build_fact(df, dim_sensor), dim_sensor, build_time_dim(df, grain)


def test_hour_grain_is_unique_and_reading_grain_fans_out(spark, two_in_an_hour):
    fact, sensor, hour = gold(two_in_an_hour, "hour")
    assert hour.count() == hour.select("hour_key").distinct().count() == 2
    assert star(fact, sensor, hour).count() == 3
    reading = build_time_dim(two_in_an_hour, "reading")
    assert star(fact, sensor, reading).count() == 5
    with pytest.raises(ValueError):
        build_time_dim(two_in_an_hour, "minute")


@pytest.mark.parametrize("grain", ["hour", "reading"])
def test_reports_equal_the_plain_star_join(spark, two_in_an_hour, grain):
    fact, sensor, time = gold(two_in_an_hour, grain)
    joined = star(fact, sensor, time)

    def same(report, plain, order):
        assert report.orderBy(order).collect() == plain.orderBy(order).collect()

    n = F.count("*").alias("readings")
    same(reports.readings_per_hour(fact, time), joined.groupBy("year", "month", "day", "hour").agg(n), "day")
    same(reports.dash_by_level(fact, time), joined.groupBy("level").agg(n), "level")
    same(reports.dash_by_type(fact, sensor, time), joined.groupBy("sensor_type").agg(n), "sensor_type")
    avg = F.avg("value").alias("avg_value")
    same(reports.dash_avg_by_sensor(fact, sensor, time), joined.groupBy("sensor_id").agg(avg), "sensor_id")
    same(reports.dash_trend(fact, time), joined.groupBy("ts").agg(avg), "ts")
    same(reports.monthly_summary(fact, time, 2025), joined.groupBy("year", "month").agg(avg, n), "month")
    daily = joined.groupBy("year", "month", "day", "sensor_type").agg(
        F.max("value").alias("max_value"), F.min("value").alias("min_value"), n)
    same(reports.daily_summary(fact, sensor, time, 2025, 6), daily, "day")
    assert reports.monthly_summary(fact, time, 2024).count() == 0


def test_critical_events_against_reading_times(spark, two_in_an_hour):
    fact, sensor, time = gold(two_in_an_hour, "reading")
    row = reports.critical_events_by_reading_time(fact, sensor, time).collect()
    assert [(r["sensor_id"], r["n_times"]) for r in row] == [(1, 2)]
    assert star(fact, sensor, time).where("level = 'CRITICA'").count() == sum(r["n_times"] for r in row)


def test_nan_values_are_skipped_like_missing_ones(spark):
    rows = silver(spark, [(1, datetime(2025, 6, 1), "a", "x", float("nan"), "NORMAL"),
                          (1, datetime(2025, 6, 1), "b", "x", 4.0, "NORMAL"),
                          (None, datetime(2025, 6, 1), "c", "x", 4.0, "NORMAL")])
    assert reports.avg_by_sensor_raw(rows).collect() == [(1, 4.0)]


def test_sensor_with_two_types(spark):
    df = silver(spark, [(1, datetime(2025, 6, 1), "a", "presion", 1.0, "NORMAL"),
                        (1, datetime(2025, 6, 1), "b", "vibracion", 2.0, "NORMAL"),
                        (2, datetime(2025, 6, 1), "c", None, 3.0, "NORMAL")])
    dim = build_sensor_dim(df)
    assert [r["sensor_key"] for r in dim.orderBy("sensor_id", "sensor_type").collect()] == [1, 2, 3]
    assert build_fact(df, dim).count() == 3
    assert build_fact(df, dim, on=["sensor_id"]).count() == 5


def test_positions_are_dense_across_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("x"))
    rows = with_position(df, ["x"], "n").orderBy("x").collect()
    assert [r["n"] for r in rows] == list(range(1, 5001))
    assert with_position(spark.range(0), ["id"], "n").collect() == []
    assert with_surrogate_key(df, ["x"], "k").schema["k"].dataType.simpleString() == "int"


def test_running_total(spark):
    df = spark.range(0, 1000, 1, 5).select("id", (F.col("id") % 3).alias("w"))
    rows = with_running_total(df, ["id"], "w", "total").orderBy("id").collect()
    total = 0
    for r in rows:
        total += r["w"]
        assert r["total"] == total


@pytest.fixture(scope="module")
def gold_root(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("gold")
    hours = F.timestamp_add("MINUTE", F.col("id") * 13, F.lit("2025-04-01").cast("timestamp"))
    df = spark.range(0, 40000).select(
        (F.col("id") % 15).cast("int").alias("sensor_id"), hours.cast("date").alias("event_date"), hours.alias("ts"),
        F.col("id").cast("string").alias("reading_id"), F.lit("presion").alias("sensor_type"),
        (F.col("id") % 100).cast("double").alias("value"), F.lit("NORMAL").alias("raw_level"),
        F.current_timestamp().alias("_extracted_at"), F.lit("x").alias("_source"), F.lit("NORMAL").alias("level"))
    lake.write_silver(df, f"{root}/silver")
    jobs.build_gold(spark, f"{root}/silver", f"{root}/gold")
    return str(root)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_on_written_gold(spark, gold_root):
    fact, sensor, time = (lake.read(spark, f"{gold_root}/gold", n) for n in ("fact_readings", "dim_sensor", "dim_time"))
    plan = plan_of(reports.monthly_summary(fact, time, 2025))
    assert "GreaterThanOrEqual(hour_key,2025010000)" in plan and "BroadcastHashJoin" in plan
    plan = plan_of(reports.alerts_by_type(fact, sensor))
    assert "EqualTo(level,CRITICA)" in plan and "value" in plan
    # key types agree, so no join key is cast
    join = plan_of(star(fact, sensor, time))
    assert "cast(sensor_key" not in join and "cast(hour_key" not in join
    assert "raw_level" not in plan_of(reports.count_by_level(fact))


def test_hot_sensor_is_split_when_the_dimension_is_too_large_to_broadcast(spark):
    """Half of the readings are of one sensor; adaptive execution splits its partition."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    hot = F.when(F.col("id") % 2 == 0, 1).otherwise((F.col("id") % 5000).cast("int"))
    df = spark.range(0, 200000, 1, 8).select(
        hot.alias("sensor_id"), F.timestamp_seconds("id").alias("ts"), F.lit("presion").alias("sensor_type"),
        F.rand(1).alias("value"), F.lit("NORMAL").alias("level"))
    dim = build_sensor_dim(df)
    before = {c: spark.conf.get(c, None) for c in confs}
    try:
        for c, v in confs.items():
            spark.conf.set(c, v)
        fact = build_fact(df, dim)
        assert fact.count() == 200000
        rows = build_fact(df, dim)
        rows.collect()
        assert "skew=true" in plan_of(rows)
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def test_clustering_gives_disjoint_row_groups(spark, gold_root, tmp_path):
    import pyarrow.parquet as pq

    target = str(tmp_path / "clustered")
    jobs.cluster_gold(spark, f"{gold_root}/gold", target, row_group_bytes=1 << 16, partitions=3)
    ranges = []
    for file in (tmp_path / "clustered" / "fact_readings").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        column = meta.schema.names.index("hour_key")
        for i in range(meta.num_row_groups):
            stats = meta.row_group(i).column(column).statistics
            ranges.append((stats.min, stats.max))
    ranges.sort()
    assert len(ranges) > 3
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    before, after = (lake.read(spark, r, "fact_readings") for r in (f"{gold_root}/gold", target))
    assert before.exceptAll(after).count() == 0 and after.count() == before.count()
    with pytest.raises(ValueError):
        lake.cluster_fact(spark, target, target + "/")


def test_one_hour_with_most_rows_fills_several_files(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(0, 20000, 1, 4).select(
        F.lit(1).alias("sensor_key"), F.when(F.col("id") % 10 > 0, 2025060108).otherwise(2025060100 + F.col("id") % 7)
        .cast("bigint").alias("hour_key"), F.lit(1.0).alias("value"), F.lit("NORMAL").alias("level")
    ).write.parquet(source)
    lake.cluster_fact(spark, source, target, partitions=4)
    sizes = [r["count"] for r in spark.read.parquet(target).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 8000 and sum(sizes) == 20000


def test_align_key_types(spark):
    dim = spark.sql("select 1L as sensor_key, 5L as sensor_id")
    fact = spark.sql("select 1 as sensor_key")
    a, b = lake.align_key_types(dim, fact, {"sensor_key": "int", "sensor_id": "int"})
    assert dict(a.dtypes) == {"sensor_key": "int", "sensor_id": "int"} and dict(b.dtypes) == {"sensor_key": "int"}
    wide = spark.sql("select 3000000000L as sensor_key")
    with pytest.raises(Exception):
        lake.align_key_types(wide, fact, {"sensor_key": "int"})[0].collect()


def test_known_sensors_keep_their_keys(spark):
    schema = "sensor_id int, sensor_type string"
    dim = build_sensor_dim(spark.createDataFrame([(5, "a"), (9, None)], schema))
    new = extend_sensor_dim(dim, spark.createDataFrame([(1, "a"), (5, "a"), (5, "b"), (9, None), (1, "a")], schema))
    assert sorted(map(tuple, new.select("sensor_id", "sensor_type", "sensor_key").collect())) == [(1, "a", 3), (5, "b", 4)]
    assert new.dtypes == dim.dtypes
    assert extend_sensor_dim(dim.limit(0), dim.select("sensor_id", "sensor_type")).count() == 2
