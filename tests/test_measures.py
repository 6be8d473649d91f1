import math
import statistics
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sensorlake.functions.levels import BANDS, classify_fixed
from sensorlake.operators import quality, rollups
from sensorlake.sources import batches, lake
from sensorlake.streaming import increments, streams

LEVELED = "sensor_id int, ts timestamp, reading_id string, sensor_type string, value double, level string"


@pytest.fixture(scope="module")
def leveled(spark):
    rows = [(i % 3, datetime(2025, 6, 1) + timedelta(hours=i), str(i), "presion", float(i),
             "CRITICA" if i % 4 == 0 else "NORMAL") for i in range(48)]
    return spark.createDataFrame(rows, LEVELED)


def test_null_counts(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (None, 1.0, "x"), (None, None, "y")], "a int, b double, c string")
    assert {r["column"]: r["nulls"] for r in quality.null_counts(df).collect()} == {"a": 2, "b": 2, "c": 1}


def test_quality_report_counts_both_layers(spark):
    bronze, silver = spark.range(5).toDF("x"), spark.range(3).toDF("x")
    assert quality.quality_report(bronze, silver).collect() == [("x", 0, 5, 3)]


@pytest.mark.parametrize("few", [10, 20_000])
def test_quartiles_by_shrinking_windows_are_exact(spark, monkeypatch, few):
    monkeypatch.setattr(quality, "_FEW", few)
    df = spark.range(30_000).select(
        ((F.col("id") * 7919) % 30_011 / 3).alias("spread"), F.pow(F.col("id") % 1000, F.lit(5)).alias("skewed"),
        F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).when(F.col("id") % 5 == 0, F.col("id").cast("double")).alias("gaps"),
        F.lit(7).alias("same"), (F.col("id") % 2).cast("decimal(10,2)").alias("two"), F.lit(None).cast("int").alias("none"),
        F.when(F.col("id") == 5, 1e300).when(F.col("id") == 6, -1e300).otherwise((F.col("id") * 31) % 997 / 7).alias("wide"),
        F.when(F.col("id") == 9, 4.5).alias("one"))
    rows = {r["column"]: r for r in quality.describe_all(df).collect()}
    for name in df.columns:
        kept = sorted(float(r[0]) for r in df.select(name).collect() if r[0] is not None and not math.isnan(r[0]))
        assert rows[name]["count"] == len(kept)
        for figure, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            if kept:
                spot = (len(kept) - 1) * share
                lo, hi = kept[math.floor(spot)], kept[math.ceil(spot)]
                assert rows[name][figure] == lo + (hi - lo) * (spot - math.floor(spot))
            else:
                assert rows[name][figure] is None


def test_describe_matches_the_definition(spark):
    numbers = [float((i * 37) % 101) / 4 for i in range(250)] + [None, float("nan")]
    texts = ["b", "a", "a", "b", "c", None] * 42
    df = spark.createDataFrame(list(zip(numbers, texts)), "n double, s string")
    rows = {r["column"]: r for r in quality.describe_all(df).collect()}
    kept = sorted(x for x in numbers if x is not None and not math.isnan(x))

    def share(q):
        spot = (len(kept) - 1) * q
        lo, hi = math.floor(spot), math.ceil(spot)
        return kept[lo] + (kept[hi] - kept[lo]) * (spot - lo)

    n = rows["n"]
    assert n["count"] == 250 and n["min"] == kept[0] and n["max"] == kept[-1] and n["unique"] is None
    assert [n[c] for c in ("q25", "q50", "q75")] == pytest.approx([share(q) for q in (0.25, 0.5, 0.75)])
    assert n["mean"] == pytest.approx(statistics.mean(kept)) and n["std"] == pytest.approx(statistics.stdev(kept))
    s = rows["s"]
    assert (s["count"], s["unique"], s["top"], s["freq"], s["mean"]) == (210, 3, "a", 84, None)


def test_describe_counts_times_as_seconds(spark):
    df = spark.createDataFrame([(datetime(1970, 1, 1, 0, 0, s),) for s in (1, 2, 4)], "ts timestamp")
    row = quality.describe_all(df).first()
    assert (row["count"], row["min"], row["q50"], row["q75"], row["max"]) == (3, 1.0, 2.0, 3.0, 4.0)


def test_describe_of_only_missing_values(spark):
    rows = quality.describe_all(spark.createDataFrame([(None,), (None,)], "s string")).collect()
    assert [(r["count"], r["unique"], r["top"], r["freq"]) for r in rows] == [(0, 0, None, None)]


def test_missing_values_do_not_enter_measures(spark):
    rows = [(1, datetime(2025, 6, 1), "a", "presion", v, None) for v in (10.0, None, float("nan"), 20.0)]
    df = spark.createDataFrame(rows, LEVELED)
    row = rollups.rollup_readings(df, "day").first()
    assert (row["readings"], row["avg_value"], row["min_value"], row["max_value"]) == (4, 15.0, 10.0, 20.0)
    row = rollups.semi_additive(df, ["sensor_type"]).first()
    assert (row["avg_value"], row["max_value"]) == (15.0, 20.0)
    leveled = df.withColumn("level", classify_fixed(F.col("value"))).collect()
    assert [r["level"] for r in leveled] == ["NORMAL", None, None, "NORMAL"]


def test_describe_has_a_row_for_every_column(spark):
    df = spark.createDataFrame([(None, Decimal("1.50"), "x"), (None, Decimal("2.50"), None)], "a double, b decimal(9,2), c string")
    rows = {r["column"]: r for r in quality.describe_all(df).collect()}
    assert rows.keys() == {"a", "b", "c"}
    assert (rows["a"]["count"], rows["a"]["mean"], rows["a"]["unique"]) == (0, None, None)
    assert (rows["b"]["count"], rows["b"]["mean"], rows["b"]["max"]) == (2, 2.0, 2.5)
    assert {r["column"]: r["count"] for r in quality.describe_all(df.limit(0)).collect()} == {"a": 0, "b": 0, "c": 0}


def test_rollups(spark, leveled):
    turbines = spark.createDataFrame([(0, 10), (1, 10), (2, 20)], "sensor_id int, turbine_id int")
    day = rollups.rollup_readings(leveled, "day", "turbine_id", turbines).orderBy("period", "turbine_id").collect()
    assert sum(r["readings"] for r in day) == 48 and sum(r["alerts"] for r in day) == 12
    own = [float(i) for i in range(24) if i % 3 != 2]
    assert day[0]["avg_value"] == pytest.approx(statistics.mean(own)) and day[0]["max_value"] == max(own)
    alerts = rollups.alert_frequency(leveled, "month", "turbine_id", turbines).orderBy("turbine_id").collect()
    assert [(r["turbine_id"], r["alerts"]) for r in alerts] == [(10, 8), (20, 4)]
    with pytest.raises(ValueError):
        rollups.rollup_readings(leveled, "day", "turbine_id")
    with pytest.raises(ValueError):
        rollups.rollup_readings(leveled, "minute")


def test_alert_measures(spark, leveled):
    assert rollups.alert_counts(leveled, "month", ["sensor_type"]).first()["alerts"] == 12
    by_level = rollups.alert_frequency(leveled, "month", "sensor_type").collect()
    assert [(r["level"], r["alerts"]) for r in by_level] == [("CRITICA", 12)]


def test_semi_additive_refuses_mixed_types(leveled):
    assert rollups.semi_additive(leveled, ["sensor_type"]).collect() == [("presion", 23.5, 47.0)]
    with pytest.raises(ValueError):
        rollups.semi_additive(leveled, ["sensor_id"])


def test_profile_and_csv(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert lake.profile_tables(spark, str(tmp_path), ["t"]).collect() == [("t", 3, 1, "id", "bigint")]
    lake.write_csv(spark.sql("select 'a' as x, 1.5 as y"), str(tmp_path / "csv"))
    lines = [p.read_text() for p in (tmp_path / "csv").glob("*.csv")]
    assert lines == ["x,y\na,1.5\n"]


# --- streaming: several files, one after the other ---

@pytest.fixture(scope="module")
def arriving(spark, leveled, tmp_path_factory):
    root = tmp_path_factory.mktemp("arriving")
    for i, (lo, hi) in enumerate([(0, 20), (20, 34), (34, 48)]):
        leveled.where(F.col("value").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(str(root))
    return str(root)


def drained(spark, tmp_path, stream):
    streams.run_available(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    return spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))


def test_stream_hourly_emits_closed_hours(spark, arriving, tmp_path):
    source = streams.stream_readings(spark, arriving, "parquet", LEVELED, files_per_trigger=1)
    rows = drained(spark, tmp_path, streams.stream_hourly(source, "2 hours")).collect()
    assert len(rows) == 45 and {r["readings"] for r in rows} == {1}


def test_whole_hours_and_sessions_equal_batch_with_a_late_file(spark, leveled, tmp_path):
    root = str(tmp_path / "in")
    # the last file is older than any delay would allow
    for lo, hi in [(20, 34), (34, 48), (0, 20)]:
        leveled.where(F.col("value").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(root)
    source = streams.stream_readings(spark, root, "parquet", LEVELED, files_per_trigger=1)
    hours = streams.run_whole(streams.stream_hourly(source, delay=None), str(tmp_path / "h"), str(tmp_path / "hs"))
    assert sorted(map(tuple, hours.collect())) == sorted(map(tuple, leveled.groupBy(
        F.date_trunc("hour", "ts")).count().collect()))
    sessions = streams.run_whole(
        streams.stream_sessions(source, gap="13 hours", delay=None), str(tmp_path / "s"), str(tmp_path / "ss")).collect()
    assert sorted((r["sensor_id"], r["readings"]) for r in sessions) == [(0, 4), (1, 4), (2, 4)]


def test_stream_alerts_equal_batch(spark, arriving, leveled, tmp_path):
    source = streams.stream_readings(spark, arriving, "parquet", LEVELED).drop("level").withColumn("raw_level", F.lit("x"))
    out = drained(spark, tmp_path, streams.stream_alerts(source.withColumn("value", F.col("value") * 2)))
    assert sorted(r["value"] for r in out.collect()) == [float(2 * i) for i in range(31, 48)]


def test_stream_alerts_by_type(spark, arriving, tmp_path):
    source = streams.stream_readings(spark, arriving, "parquet", LEVELED).drop("level").withColumn("raw_level", F.lit("x"))
    out = drained(spark, tmp_path, streams.stream_alerts(source, BANDS))
    # presion: a warning from 41 on, and nothing above 59 in these readings
    assert sorted(r["value"] for r in out.where("level = 'ADVERTENCIA'").collect()) == [float(i) for i in range(41, 48)]
    assert out.count() == 7


def test_stream_dedupe_across_triggers(spark, leveled, tmp_path):
    source_dir = str(tmp_path / "in")
    for _ in range(2):
        leveled.coalesce(1).write.mode("append").parquet(source_dir)
    source = streams.stream_readings(spark, source_dir, "parquet", LEVELED, files_per_trigger=1)
    out = drained(spark, tmp_path, streams.stream_dedupe(source, "100 hours"))
    assert out.count() == out.select("sensor_id", "ts").distinct().count() == 48


def test_stream_sessions(spark, arriving, tmp_path):
    source = streams.stream_readings(spark, arriving, "parquet", LEVELED, files_per_trigger=1)
    out = drained(spark, tmp_path, streams.stream_sessions(source, gap="13 hours", delay="30 minutes"))
    # alerts of a sensor are 12 hours apart, so no session is closed before the data ends
    assert out.count() == 0
    other = tmp_path / "b"
    other.mkdir()
    out = drained(spark, other, streams.stream_sessions(source, gap="5 hours", delay="30 minutes"))
    assert {(r["readings"], r["duration_s"]) for r in out.collect()} == {(1, 0.0)}


@pytest.mark.parametrize("kind", ["hours", "sessions"])
def test_increments_equal_batch_and_do_not_grow_with_history(spark, leveled, tmp_path, kind):
    source_dir, target = str(tmp_path / "in"), str(tmp_path / "out")
    partial, total = (increments.hourly, increments.hourly_total) if kind == "hours" else increments.sessions("13 hours")
    schema, seen = partial(leveled).schema, None

    def arrives(rows):
        rows.coalesce(1).write.mode("append").parquet(source_dir)
        stream = streams.stream_readings(spark, source_dir, "parquet", LEVELED, files_per_trigger=1)
        increments.run_increments(stream, partial, target, str(tmp_path / "state"))

    def whole():
        return sorted(map(tuple, increments.read_whole(spark, target, total, schema).collect()))

    # the last files are older than any delay would allow, and one of them lies in the middle of a session
    pieces = [leveled.where(F.col("value").between(lo, hi - 1)) for lo, hi in [(20, 24), (34, 48), (24, 34), (0, 20)]]
    for n, piece in enumerate(pieces):
        arrives(piece)
        seen = piece if seen is None else seen.unionByName(piece)
        assert whole() == sorted(map(tuple, partial(seen).collect()))
        if n == 1:
            increments.compact(spark, target, total, schema)
            assert increments.segments(spark, target) == ["000000000000-000000000001"] == batches.complete(spark, target)
            assert whole() == sorted(map(tuple, partial(seen).collect()))
    # a trigger that is repeated after a failure leaves one copy, also of what has been put together since
    batches.write_batch(partial(pieces[1]), target, "000000000001-000000000001", "segment")
    batches.write_batch(partial(pieces[2]), target, "000000000002-000000000002", "segment")
    assert whole() == sorted(map(tuple, partial(seen).collect()))
    # a trigger holds its own rows only, and no state is kept
    assert sum(spark.read.parquet(batches.folder(spark, target, name, "segment")).count() for name in increments.segments(
        spark, target)[1:]) == sum(partial(piece).count() for piece in pieces[2:])
    assert not (tmp_path / "state" / "state").exists()


def test_no_triggers_yet(spark, tmp_path, leveled):
    schema = increments.hourly(leveled).schema
    assert increments.read_whole(spark, str(tmp_path / "none"), increments.hourly_total, schema).count() == 0


@pytest.mark.parametrize("by, grain", [("sensor_id", "day"), ("sensor_type", "month"), ("turbine_id", "hour"), ("sensor_id", "hour")])
def test_rollups_of_stored_hours_equal_those_of_readings(spark, by, grain):
    rows = [(i % 5, datetime(2025, 6, 1) + timedelta(minutes=17 * i), str(i), "presion" if i % 2 else "temperatura",
             [float(i), None, float("nan")][i % 7 % 3], ["CRITICA", "NORMAL", None][i % 3]) for i in range(400)]
    readings = spark.createDataFrame(rows, LEVELED).withColumn("event_date", F.to_date("ts"))
    turbines = spark.createDataFrame([(i, i % 2) for i in range(5)], "sensor_id int, turbine_id int")
    args = (grain, by, turbines if by == "turbine_id" else None)
    rounded = lambda df: sorted(map(str, df.withColumn("avg_value", F.round("avg_value", 9)).collect()))
    assert rounded(rollups.rollup_cells(rollups.hourly_cells(readings), *args)) == rounded(rollups.rollup_readings(readings, *args))
    with pytest.raises(ValueError):
        rollups.rollup_cells(rollups.hourly_cells(readings), "week")
