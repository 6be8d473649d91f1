"""The analytic queries, over gold tables or over raw readings.

Reports on gold weight by the time dimension's rows per hour key, so they are
exact for an hour-grain and for a reading-grain time dimension alike. Whether
they join or sum up first depends on the size of the dimensions, see
``operators.star.cells``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.levels import CRITICAL
from ..functions.timeparts import hour_key_between, hour_of_day
from ..operators.star import cell_avg, cell_count, cells, hours

W = "weight"  # rows per hour key, from operators.star.hours


# --- five queries on gold ---------------------------------------------------

def avg_by_sensor(fact: DataFrame, dim_sensor: DataFrame) -> DataFrame:
    return cells(fact, "sensor_key").join(dim_sensor, "sensor_key").groupBy("sensor_id").agg(
        cell_avg().alias("avg_value"))


def readings_per_hour(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    parts = ["year", "month", "day", "hour"]
    times = hours(dim_time)
    return cells(fact, "hour_key").join(times, "hour_key").groupBy(*parts).agg(
        cell_count(F.col(W)).alias("readings")).orderBy(*parts)


def count_by_level(fact: DataFrame) -> DataFrame:
    return fact.groupBy("level").agg(F.count("*").alias("readings"))


def avg_by_type(fact: DataFrame, dim_sensor: DataFrame) -> DataFrame:
    return cells(fact, "sensor_key").join(dim_sensor, "sensor_key").groupBy("sensor_type").agg(
        cell_avg().alias("avg_value"))


def critical_events(fact: DataFrame, dim_sensor: DataFrame, dim_time: DataFrame,
                    level: str = CRITICAL) -> DataFrame:
    """Readings of one level by time; the time dimension must be at hour grain."""
    return (
        fact.where(F.col("level") == level)
        .join(dim_sensor.select("sensor_key", "sensor_id"), "sensor_key")
        .join(dim_time.select("hour_key", "ts"), "hour_key")
        .select("sensor_id", "ts", "value", "level").orderBy("ts", "sensor_id", "value")
    )


def critical_events_by_reading_time(fact: DataFrame, dim_sensor: DataFrame, dim_time: DataFrame,
                                    level: str = CRITICAL) -> DataFrame:
    """Critical readings against a reading-grain time dimension, in compact form.

    The plain join lists each reading once per reading time of its hour, which
    grows with the square of the readings in an hour. Here every reading is one
    row that carries the number, first and last of those times.
    """
    times = dim_time.groupBy("hour_key").agg(
        F.count("*").alias("n_times"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return (
        fact.where(F.col("level") == level)
        .join(dim_sensor.select("sensor_key", "sensor_id"), "sensor_key").join(times, "hour_key")
        .select("sensor_id", "value", "level", "n_times", "first_ts", "last_ts")
        .orderBy("first_ts", "sensor_id", "value")
    )


# --- five queries on raw readings -------------------------------------------

def avg_by_sensor_raw(readings: DataFrame) -> DataFrame:
    return _mean_by(readings, "sensor_id").orderBy("sensor_id")


def readings_by_hour_of_day(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("ts").isNotNull()).groupBy(hour_of_day(F.col("ts")).alias("hour")).agg(
        F.count("*").alias("readings"))


def count_by_raw_level(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("raw_level").isNotNull()).groupBy("raw_level").agg(
        F.count("*").alias("readings")).orderBy(F.desc("readings"), "raw_level")


def avg_by_type_raw(readings: DataFrame) -> DataFrame:
    return _mean_by(readings, "sensor_type").orderBy("sensor_type")


def critical_events_raw(readings: DataFrame, level: str = CRITICAL) -> DataFrame:
    return readings.where(F.col("raw_level") == level)


def _mean_by(readings: DataFrame, key: str) -> DataFrame:
    """Mean per key, without a group for a missing key and without NaN values."""
    number = F.nanvl(F.col("value"), F.lit(None).cast("double"))
    return readings.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(number).alias("avg_value"))


# --- three period reports ----------------------------------------------------

def monthly_summary(fact: DataFrame, dim_time: DataFrame, year: int) -> DataFrame:
    in_year = fact.where(hour_key_between(F.col("hour_key"), year))
    times = hours(dim_time.where(F.col("year") == year))
    return (
        cells(in_year, "hour_key").join(times, "hour_key")
        .groupBy("year", "month").agg(cell_avg(F.col(W)).alias("avg_value"), cell_count(F.col(W)).alias("readings"))
        .orderBy("month")
    )


def alerts_by_type(fact: DataFrame, dim_sensor: DataFrame, level: str = CRITICAL) -> DataFrame:
    return (
        cells(fact.where(F.col("level") == level), "sensor_key", "level")
        .join(dim_sensor, "sensor_key")
        .groupBy("sensor_type", "level").agg(cell_count().alias("readings"), cell_avg().alias("avg_value"))
        .orderBy(F.desc("readings"), "sensor_type")
    )


def daily_summary(fact: DataFrame, dim_sensor: DataFrame, dim_time: DataFrame, year: int, month: int) -> DataFrame:
    in_month = fact.where(hour_key_between(F.col("hour_key"), year, month))
    times = hours(dim_time.where((F.col("year") == year) & (F.col("month") == month)))
    return (
        cells(in_month, "hour_key", "sensor_key")
        .join(times, "hour_key").join(dim_sensor, "sensor_key")
        .groupBy("year", "month", "day", "sensor_type")
        .agg(F.max("hi").alias("max_value"), F.min("lo").alias("min_value"), cell_count(F.col(W)).alias("readings"))
        .orderBy("day", "sensor_type")
    )


# --- dashboard figures: the star join, without a dimension that cannot change the figure -----
# A fact has exactly one sensor row, so only figures per sensor or type need that join.

def dash_by_type(fact: DataFrame, dim_sensor: DataFrame, dim_time: DataFrame) -> DataFrame:
    sensors, times = dim_sensor.where(F.col("sensor_type").isNotNull()), hours(dim_time)
    return (
        cells(fact, "hour_key", "sensor_key")
        .join(sensors, "sensor_key").join(times, "hour_key")
        .groupBy("sensor_type").agg(cell_count(F.col(W)).alias("readings"))
        .orderBy(F.desc("readings"), "sensor_type")
    )


def dash_by_level(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    times = hours(dim_time)
    return (
        cells(fact.where(F.col("level").isNotNull()), "hour_key", "level").join(times, "hour_key")
        .groupBy("level").agg(cell_count(F.col(W)).alias("readings")).orderBy(F.desc("readings"), "level")
    )


def level_share(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Percent of all readings per level, one decimal."""
    # the window spans one row per level
    total = F.sum("readings").over(Window.partitionBy())
    return dash_by_level(fact, dim_time).withColumn("percent", F.round(F.col("readings") * 100.0 / total, 1))


def dash_avg_by_sensor(fact: DataFrame, dim_sensor: DataFrame, dim_time: DataFrame) -> DataFrame:
    times = hours(dim_time)
    return (
        cells(fact, "hour_key", "sensor_key")
        .join(times, "hour_key").join(dim_sensor, "sensor_key")
        .groupBy("sensor_id").agg(cell_avg(F.col(W)).alias("avg_value")).orderBy("sensor_id")
    )


def dash_trend(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Mean value per time of the time dimension, at whatever grain that has."""
    means = cells(fact, "hour_key").select("hour_key", F.try_divide("total", "n_value").alias("avg_value"))
    return dim_time.select("ts", "hour_key").join(means, "hour_key").select("ts", "avg_value").orderBy("ts")
