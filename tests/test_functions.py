from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensorlake.functions import levels, timeparts


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("kind, number, level", [
    ("temperatura", 75.0, "NORMAL"), ("temperatura", 75.5, None), ("temperatura", 76.0, "ADVERTENCIA"),
    ("nivel_agua", 35.0, "CRITICA"), ("vibracion", 0.5, None), ("unknown", 50.0, None)])
def test_bands_are_closed_with_gaps(spark, kind, number, level):
    assert value(spark, levels.classify_by_type(F.lit(kind), F.lit(number))) == level


def test_valid_range(spark):
    rows = spark.createDataFrame(
        [("presion", 20.0), ("presion", 80.0), ("presion", 80.5), ("other", 30.0), (None, 30.0)],
        "sensor_type string, value double")
    assert [r["in_range"] for r in levels.validate_range(rows).collect()] == [True, True, False, False, False]
    assert levels.validate_range(rows, mode="drop").count() == 2
    with pytest.raises(ValueError):
        levels.validate_range(rows, mode="other")


def test_deviation(spark):
    rows = spark.createDataFrame([("vibracion", 7.0)], "sensor_type string, value double")
    assert levels.threshold_deviation(rows).first()["deviation"] == -73.0
    assert levels.threshold_deviation(rows, per_type=True).first()["deviation"] == 2.0


def test_level_of_a_missing_level_is_no_alert(spark):
    assert value(spark, levels.is_alert(F.lit(None).cast("string"))) is False


@pytest.mark.parametrize("ts, key", [
    ("2025-06-01 08:00:00", 2025060108), ("2025-06-01 08:59:59.999999", 2025060108), ("2150-12-31 23:00:00", 2150123123)])
def test_hour_key(spark, ts, key):
    assert value(spark, timeparts.hour_key(F.lit(ts).cast("timestamp"))) == key


def test_weekday(spark):
    assert value(spark, timeparts.weekday(F.lit("2025-06-01").cast("timestamp"))) == "0"
    assert value(spark, timeparts.weekday(F.lit("2025-06-07").cast("timestamp"))) == "6"


@pytest.mark.parametrize("key, year, month, inside", [
    (2025010100, 2025, None, True), (2025123123, 2025, None, True), (2024123123, 2025, None, False),
    (2025063023, 2025, 6, True), (2025070100, 2025, 6, False), (2026010100, 2025, None, False)])
def test_hour_key_range(spark, key, year, month, inside):
    assert value(spark, timeparts.hour_key_between(F.lit(key), year, month)) is inside


def test_calendar(spark):
    rows = spark.createDataFrame([(datetime(2025, 6, 7, 8, 5),), (datetime(2025, 6, 9, 8, 6),)], "ts timestamp")
    holidays = spark.sql("select date'2025-06-09' as holiday union all select date'2025-06-09'")
    out = timeparts.with_calendar(rows, "ts", holidays).orderBy("ts").collect()
    assert [(r["minute"], r["is_weekend"], r["is_holiday"]) for r in out] == [(5, True, False), (6, False, True)]
    assert not any(r["is_holiday"] for r in timeparts.with_calendar(rows).collect())


def test_small_functions(spark):
    assert value(spark, timeparts.gain(F.lit(6.0), F.lit(1.5))) == 4.0
    assert value(spark, timeparts.gain(F.lit(6.0), F.lit(0.0))) is None
    lima = timeparts.utc(F.lit("2025-06-01 08:00:00").cast("timestamp"), "America/Lima")
    assert value(spark, lima) == datetime(2025, 6, 1, 13)
    assert value(spark, timeparts.stamp(F.lit("2025-06-01 08:05:00").cast("timestamp"))) == "20250601_0805"
    ids = [value(spark, timeparts.reading_uuid(F.lit(1), F.lit(x))) for x in ("a", "a", "b")]
    assert ids[0] == ids[1] != ids[2]


def test_times_without_a_full_date_are_no_times(spark):
    texts = ["10:30", "2024", "T10:00", "2024-05", "2025-06-01 10:30:00", "2025-06-01T10:30", " 2025-06-01 ", "2025-06-01x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "ts string")
    found = [r[0] for r in rows.select(timeparts.parse_ts(rows, "ts")).collect()]
    at = datetime(2025, 6, 1, 10, 30)
    assert found == [None] * 4 + [at, at, datetime(2025, 6, 1), None, None]


def test_parse_ts(spark):
    rows = spark.createDataFrame([("2025-06-01 08:00:00",), ("x",)], "ts string")
    assert [r[0] for r in rows.select(timeparts.parse_ts(rows, "ts")).collect()] == [datetime(2025, 6, 1, 8), None]
    with pytest.raises(Exception):
        rows.select(timeparts.parse_ts(rows, "ts", strict=True)).collect()
