"""Measures per sensor, type, turbine and period."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.levels import is_alert

_PERIODS = ("hour", "day", "month")


def _period(grain: str) -> Column:
    if grain not in _PERIODS:
        raise ValueError(f"grain must be one of {_PERIODS}")
    return F.date_trunc(grain, "ts").alias("period")


def _present(value: str = "value") -> Column:
    """The value, NULL also for NaN: a missing value counts as a reading but not in its measures."""
    return F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))


def _cells(readings: DataFrame, by: str, grain: str) -> DataFrame:
    """Readings summed up per ``by`` and period."""
    value = _present()
    return readings.groupBy(by, _period(grain)).agg(
        F.count("*").alias("readings"), F.count(value).alias("values"), F.sum(value).alias("total"),
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.count_if(is_alert(F.col("level"))).alias("alerts"))


def _needed(turbines: DataFrame | None) -> DataFrame:
    if turbines is None:
        raise ValueError("by='turbine_id' needs the sensor to turbine mapping")
    return turbines.select("sensor_id", "turbine_id")


def hourly_cells(readings: DataFrame, deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """What every roll-up needs of the readings, per sensor, type and hour: sums that add up to those of longer periods.

    Stored in folders by day (see ``jobs.refresh_days``), they are made anew for
    the days that a batch touches, and roll-ups read them instead of readings.
    ``deal`` may deal the readings by ranges of the cells' columns: cells that
    are mostly single readings are then shuffled once, in the order of their files.
    """
    rows = readings.select(
        "sensor_id", "sensor_type", "event_date", F.date_trunc("hour", "ts").alias("hour"), _present().alias("value"),
        is_alert(F.col("level")).alias("alert"))
    return (deal(rows) if deal else rows).groupBy("sensor_id", "sensor_type", "event_date", "hour").agg(
        F.count("*").alias("readings"), F.count("value").alias("values"), F.sum("value").alias("total"),
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count_if("alert").alias("alerts"))


def rollup_cells(cells: DataFrame, grain: str = "hour", by: str = "sensor_id", turbines: DataFrame | None = None) -> DataFrame:
    """The same as ``rollup_readings`` of the readings, from their ``hourly_cells``."""
    own = "sensor_id" if by == "turbine_id" else by
    if grain not in _PERIODS:
        raise ValueError(f"grain must be one of {_PERIODS}")
    summed = _summed(cells.withColumn("period", F.date_trunc(grain, "hour")), own)
    if by == "turbine_id":
        summed = _summed(summed.join(_needed(turbines), "sensor_id"), by)
    return _measures(summed, by)


def _summed(cells: DataFrame, by: str) -> DataFrame:
    return cells.groupBy(by, "period").agg(
        F.sum("readings").alias("readings"), F.sum("values").alias("values"), F.sum("total").alias("total"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("alerts").alias("alerts"))


def _measures(cells: DataFrame, by: str) -> DataFrame:
    return cells.select(
        by, "period", "readings", F.try_divide("total", "values").alias("avg_value"),
        F.col("lo").alias("min_value"), F.col("hi").alias("max_value"), "alerts")


def rollup_readings(readings: DataFrame, grain: str = "hour", by: str = "sensor_id",
                    turbines: DataFrame | None = None) -> DataFrame:
    """Readings, average, extremes and alerts per period and sensor, type or turbine.

    ``turbines`` maps sensor_id to turbine_id. It is joined to the sums per
    sensor and period, so a mapping of any size meets sums instead of readings.
    """
    cells = _cells(readings, "sensor_id" if by == "turbine_id" else by, grain)
    if by == "turbine_id":
        cells = _summed(cells.join(_needed(turbines), "sensor_id"), by)
    return _measures(cells, by)


def alert_counts(readings: DataFrame, grain: str = "day", by: Sequence[str] = ("sensor_id", "sensor_type"),
                 ) -> DataFrame:
    """Number of alerts per period and ``by``; periods without alert count zero."""
    return readings.groupBy(*by, _period(grain)).agg(F.count_if(is_alert(F.col("level"))).alias("alerts"))


def alert_frequency(readings: DataFrame, grain: str = "day", by: str = "sensor_id",
                    turbines: DataFrame | None = None) -> DataFrame:
    """Alerts per level, period and sensor, type or turbine; only what occurred."""
    alerts = readings.where(is_alert(F.col("level")))
    counts = alerts.groupBy("sensor_id" if by == "turbine_id" else by, "level", _period(grain)).agg(
        F.count("*").alias("alerts"))
    if by != "turbine_id":
        return counts
    return counts.join(_needed(turbines), "sensor_id").groupBy(by, "level", "period").agg(F.sum("alerts").alias("alerts"))


def semi_additive(readings: DataFrame, by: Sequence[str]) -> DataFrame:
    """Average and maximum, the only aggregates that make sense for a physical value.

    Missing values (NULL, NaN) are skipped. Values of different sensor types must not mix, so ``by`` has to contain the type.
    """
    if "sensor_type" not in by:
        raise ValueError("values of different sensor types do not mix: group by sensor_type")
    return readings.groupBy(*by).agg(F.avg(_present()).alias("avg_value"), F.max(_present()).alias("max_value"))
