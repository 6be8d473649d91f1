"""Runs of consecutive alert readings of a sensor."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.levels import is_alert
from .ordered import in_parts, running

TASK_ROWS = 1 << 18  # rows that a task sorts


def anomaly_episodes(readings: DataFrame, cell: str | None = None) -> DataFrame:
    """Maximal runs of alert readings per sensor, by time and then reading id.

    Two alert readings belong to the same run when the same number of calm
    readings precedes them. That number is a running total along one sort by
    sensor and time; a sensor with very many readings is cut into parts, whose
    totals are carried on, see ``in_parts``. With ``cell`` ("hour", "day", ...)
    the number is added up over (sensor, cell) and counted within a cell, so
    that cells without an alert need no sort.
    """
    rows = readings.select(
        "sensor_id", "ts", "reading_id", "value", is_alert(F.col("level")).alias("alert"))
    alerts = _by_parts(rows) if cell is None else _by_cell(rows, cell)
    micros = F.unix_micros(F.col("end_ts").cast("timestamp")) - F.unix_micros(F.col("start_ts").cast("timestamp"))
    return (
        alerts.groupBy("sensor_id", "run")
        .agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"),
             F.count("*").alias("readings"), F.max("value").alias("max_value"))
        .withColumn("duration_s", micros / F.lit(1e6)).drop("run")
    )


def _by_cell(rows: DataFrame, cell: str) -> DataFrame:
    """Alert rows with ``run``, the number of calm readings of the sensor before them.

    Cells without an alert are dropped before the window sort. The join with the
    cells uses the shuffle that the window needs anyway.
    """
    rows = rows.withColumn("cell", F.date_trunc(cell, "ts"))
    calm = F.when(F.col("alert"), 0).otherwise(1)
    earlier = Window.partitionBy("sensor_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy("sensor_id", "cell")
        .agg(F.sum(calm).alias("calm"), F.count_if("alert").alias("alerts"))
        .withColumn("calm_before", F.coalesce(F.sum("calm").over(earlier), F.lit(0)))
        .where("alerts > 0").select("sensor_id", "cell", "calm_before")
    )
    # a task sorts its rows twice, for the join and for the runs, so it gets a bounded number of them
    session = rows.sparkSession
    tasks = max(session.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    rows, before = (df.repartition(tasks, "sensor_id", "cell") for df in (rows, before))
    inside = (
        Window.partitionBy("sensor_id", "cell").orderBy("ts", "reading_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.join(before, ["sensor_id", "cell"])
        .withColumn("run", F.col("calm_before") + F.sum(calm).over(inside)).where("alert")
    )


def _by_parts(rows: DataFrame) -> DataFrame:
    """Alert rows with ``run``, the number of calm readings of the sensor before them."""
    calm = rows.withColumn("calm", F.when(F.col("alert"), 0).otherwise(1))
    parts, by = in_parts(calm, "sensor_id", "ts")
    return running(parts, by, ["ts", "reading_id"], "calm", "run").where("alert")
