"""Streams whose whole result grows by small increments: no state, no watermark, nothing late is lost.

Each trigger sums its own rows up and writes those partial sums as a segment; a
trigger that is repeated after a failure replaces its segment. Readers add the
segments up, so a window is open for ever, a late row is just a row of a later
segment, and neither the work nor the bytes of a trigger depend on what came
before. ``compact`` replaces the segments so far by one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.levels import is_alert
from ..sources import batches, paths

Sums = Callable[[DataFrame], DataFrame]


def hourly(readings: DataFrame) -> DataFrame:
    """Readings per event-time hour."""
    return readings.groupBy(F.date_trunc("hour", "ts").alias("hour_start")).agg(F.count("*").alias("readings"))


def hourly_total(parts: DataFrame) -> DataFrame:
    return parts.groupBy("hour_start").agg(F.sum("readings").alias("readings"))


def sessions(gap: str) -> tuple[Sums, Sums]:
    """Sums of readings with a level to alert sessions per sensor, and of partial sessions to whole ones.

    Alerts less than ``gap`` apart belong together. A partial session is an
    interval; those that overlap, once each is prolonged by the gap, are one.
    """
    def partial(readings: DataFrame) -> DataFrame:
        alerts = readings.where(is_alert(F.col("level")))
        found = alerts.groupBy("sensor_id", F.session_window("ts", gap)).agg(
            F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("readings"), F.max("value").alias("max_value"))
        return found.drop("session_window")

    def total(parts: DataFrame) -> DataFrame:
        reach = F.unix_micros(F.col("end_ts") + F.expr(f"interval {gap}")) - F.unix_micros("start_ts")
        found = parts.groupBy("sensor_id", F.session_window("start_ts", F.concat(reach.cast("string"), F.lit(" microseconds")))).agg(
            F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"),
            F.sum("readings").alias("readings"), F.max("max_value").alias("max_value"))
        return found.drop("session_window")

    return partial, total


def run_increments(stream: DataFrame, partial: Sums, target: str, checkpoint: str) -> None:
    """Process all that has arrived, one segment a trigger, then stop."""
    def write(rows: DataFrame, batch: int) -> None:
        batches.write_batch(partial(rows), target, f"{batch:012d}-{batch:012d}", "segment")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def segments(spark: SparkSession, target: str) -> list[str]:
    """The complete segments that count: those that no longer one contains."""
    found, last = [], -1
    spans = [(*map(int, name.split("-")), name) for name in batches.complete(spark, target)]
    for _, high, name in sorted(spans, key=lambda s: (s[0], -s[1])):
        if high > last:
            found.append(name)
            last = high
    return found


def read_whole(spark: SparkSession, target: str, total: Sums, schema: StructType) -> DataFrame:
    """The whole result of all triggers so far; ``schema`` is that of the partial sums."""
    return total(_parts(spark, target, schema, segments(spark, target)))


def _parts(spark: SparkSession, target: str, schema: StructType, names: list[str]) -> DataFrame:
    folders = [batches.folder(spark, target, name, "segment") for name in names]
    held = [f for f in folders if paths.holds_file(spark, f, ".parquet")]
    return spark.read.schema(schema).parquet(*held) if held else spark.createDataFrame([], schema)


def compact(spark: SparkSession, target: str, total: Sums, schema: StructType) -> None:
    """Replace all segments by one that holds their totals.

    The new segment counts from the moment it is complete, and only then the
    old ones go; if that is lost half-way, the next run removes them.
    """
    names = segments(spark, target)
    if len(names) > 1:
        name = f"{names[0].split('-')[0]}-{names[-1].split('-')[1]}"
        batches.write_batch(total(_parts(spark, target, schema, names)), target, name, "segment")
    counting = set(segments(spark, target))
    for name in batches.complete(spark, target):
        if name not in counting:
            batches.unmark(spark, target, name)
            paths.remove(spark, batches.folder(spark, target, name, "segment"))
