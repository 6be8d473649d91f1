"""The silver rules and period measures on Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.levels import classify_by_type, is_alert
from ..operators.cleaning import prepare, with_level
from ..schemas import LANDING


def stream_readings(spark: SparkSession, landing: str, fmt: str = "json", schema: StructType = LANDING,
                    files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Readings as they arrive in the landing folder."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(landing)


def stream_clean(stream: DataFrame, null_text: str | None = None) -> DataFrame:
    """The batch cleaning rules without the removal of copies; see ``stream_dedupe``."""
    return with_level(prepare(stream, null_text))


def stream_alerts(stream: DataFrame, bands: dict | None = None) -> DataFrame:
    """Cleaned readings whose level is not normal, without any state.

    The level follows the fixed thresholds, or the ``bands`` of the sensor type.
    """
    df = stream_clean(stream)
    if bands is not None:
        df = df.withColumn("level", classify_by_type(F.col("sensor_type"), F.col("value"), bands))
    return df.where(is_alert(F.col("level")))


def stream_dedupe(stream: DataFrame, delay: str = "1 hour",
                  keys: Sequence[str] = ("sensor_id", "ts")) -> DataFrame:
    """Drop repeated readings that arrive within ``delay`` of each other."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def _watermarked(stream: DataFrame, delay: str | None) -> DataFrame:
    return stream if delay is None else stream.withWatermark("ts", delay)


def stream_hourly(stream: DataFrame, delay: str | None = "1 hour") -> DataFrame:
    """Readings per event-time hour.

    With a ``delay`` an hour appears once it is closed, and what comes later is
    lost (append mode, bounded state). ``delay=None`` keeps every hour open, so
    late readings count and the last hours are there too; run it with
    ``run_whole``. Its state is one row per hour.
    """
    hourly = _watermarked(stream, delay).groupBy(F.window("ts", "1 hour")).agg(F.count("*").alias("readings"))
    return hourly.select(F.col("window.start").alias("hour_start"), "readings")


def stream_sessions(stream: DataFrame, gap: str = "30 minutes", delay: str | None = "1 hour") -> DataFrame:
    """Alert sessions per sensor: alerts less than ``gap`` apart belong together.

    ``stream`` has a ``level``. The duration runs from the first to the last
    alert. ``delay`` is as in ``stream_hourly``; without it the state is one row
    per session.
    """
    alerts = _watermarked(stream, delay).where(is_alert(F.col("level")))
    sessions = alerts.groupBy("sensor_id", F.session_window("ts", gap)).agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"),
        F.count("*").alias("readings"), F.max("value").alias("max_value"))
    duration = (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / F.lit(1e6)
    return sessions.select("sensor_id", "start_ts", "end_ts", "readings", "max_value", duration.alias("duration_s"))


def run_available(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Process all that has arrived, appending to Parquet exactly once, then stop."""
    stream.writeStream.format("parquet").outputMode("append").option("path", target).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_whole(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Process all that has arrived and return the whole result, open windows and late rows included.

    Every trigger writes the complete result to a folder of its own; the
    latest one counts, so readers of an earlier one are not disturbed.
    """
    spark = stream.sparkSession

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    stream.writeStream.outputMode("complete").foreachBatch(write).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    schema = StructType([*stream.schema, StructField("batch", LongType())])
    batches = spark.read.schema(schema).parquet(target)
    return batches.where(F.col("batch") == batches.agg(F.max("batch")).scalar()).drop("batch")
