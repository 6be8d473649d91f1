"""The star schema: dimensions, fact, and joins that aggregate first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import date_parts, hour_key, weekday, with_calendar
from .ordered import with_surrogate_key
from .scd import join_as_of


def build_time_dim(silver: DataFrame, grain: str = "hour", holidays: DataFrame | None = None) -> DataFrame:
    """Distinct times of the readings, with the parts of the date and the calendar's marks.

    ``holidays`` has one DATE column ``holiday``; without it no day is one.

    ``grain="hour"`` gives one row per hour and so a unique ``hour_key``.
    ``grain="reading"`` gives one row per distinct reading time, where the hour
    key repeats and a join on it multiplies rows.
    """
    if grain == "hour":
        times = silver.select(F.date_trunc("hour", "ts").alias("ts"))
    elif grain == "reading":
        times = silver.select("ts")
    else:
        raise ValueError(f"unknown grain {grain!r}")
    ts = F.col("ts")
    parts = times.distinct().select(
        hour_key(ts).alias("hour_key"), ts,
        *[part.alias(name) for name, part in date_parts(ts).items()],
        weekday(ts).alias("weekday"),
    )
    marks = ("date", "minute", "is_weekend", "is_holiday")
    return with_calendar(parts, "ts", holidays).select(*parts.columns, *marks)


def build_sensor_dim(silver: DataFrame) -> DataFrame:
    """Distinct (sensor_id, sensor_type), numbered in that order."""
    pairs = silver.select("sensor_id", "sensor_type").distinct()
    return with_surrogate_key(pairs, ["sensor_id", "sensor_type"], "sensor_key")


def extend_sensor_dim(dim: DataFrame, silver: DataFrame) -> DataFrame:
    """The sensors of ``silver`` that ``dim`` lacks, with keys after its greatest, ready to be appended.

    Known sensors keep their keys, so facts written before stay right.
    """
    known = dim.select(F.col("sensor_id").alias("_id"), F.col("sensor_type").alias("_type"))
    same = (F.col("sensor_id") == F.col("_id")) & F.col("sensor_type").eqNullSafe(F.col("_type"))
    new = silver.select("sensor_id", "sensor_type").distinct().join(known, same, "left_anti")
    highest = dim.agg(F.coalesce(F.max("sensor_key"), F.lit(0))).scalar()
    numbered = with_surrogate_key(new, ["sensor_id", "sensor_type"], "sensor_key")
    return numbered.withColumn("sensor_key", F.col("sensor_key") + highest)


def build_fact(silver: DataFrame, dim_sensor: DataFrame,
               on: Sequence[str] = ("sensor_id", "sensor_type"), keep: Sequence[str] = ()) -> DataFrame:
    """Readings with the sensor's surrogate key, and the columns ``keep``.

    ``on=["sensor_id"]`` duplicates the readings of a sensor that has several
    types. No broadcast is forced: a dimension read back from files has a known
    size, so it is broadcast below ``spark.sql.autoBroadcastJoinThreshold``;
    above it the join shuffles and adaptive execution splits hot sensors.
    """
    # null-safe, because a sensor without type is a dimension row of its own
    keys = dim_sensor.select("sensor_key", *[F.col(c).alias(f"_{c}") for c in on])
    match = None
    for c in on:
        # sensor_id is never NULL in silver and stays a plain equality
        same = F.col(c) == F.col(f"_{c}") if c == "sensor_id" else F.col(c).eqNullSafe(F.col(f"_{c}"))
        match = same if match is None else match & same
    return silver.join(keys, match).select(
        "sensor_key", hour_key(F.col("ts")).alias("hour_key"), "value", "level", *keep)


def build_versioned_fact(silver: DataFrame, versions: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Readings with the key of the sensor version (see ``scd2_build``) that was valid at their time.

    Readings that no version covers have key 0. A sensor has few versions, so
    written ones of moderate size are broadcast and the readings are not
    shuffled. Versions keep their keys when updates are merged in, see
    ``versions_of``; only facts of the time that a late update covers change.
    """
    ranges = versions.select("sensor_id", "valid_from", "valid_to", "version_key")
    joined = join_as_of(silver, ranges, "sensor_id", "ts", "left", few=True)
    return joined.select(
        F.coalesce("version_key", F.lit(0).cast("bigint")).alias("version_key"), hour_key(F.col("ts")).alias("hour_key"),
        "value", "level", *keep)


def star(fact: DataFrame, dim_sensor: DataFrame, dim_time: DataFrame) -> DataFrame:
    """The plain three-way join, one row per match."""
    return fact.join(dim_sensor, "sensor_key").join(dim_time, "hour_key")


def hours(dim_time: DataFrame) -> DataFrame:
    """One row per hour key with ``weight``: how many time rows it has.

    The weight is 1 at hour grain. At reading grain it is the factor by which a
    join on the hour key multiplies a fact, so sums over that join are weighted
    sums over the facts and the multiplied rows never need to exist.
    """
    return dim_time.groupBy("hour_key", "year", "month", "day", "hour").agg(F.count("*").alias("weight"))


def cells(fact: DataFrame, *keys: str) -> DataFrame:
    """Facts summed up per ``keys``, to be joined to dimensions and summed up further.

    Only these sums are shuffled to a dimension of any size, and a sensor or
    hour with a third of all rows is summed inside each task before that.
    """
    value = F.nanvl(F.col("value"), F.lit(None).cast("double"))
    return fact.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count(value).alias("n_value"), F.sum(value).alias("total"),
        F.max("value").alias("hi"), F.min("value").alias("lo"))


def cell_count(weight: Column | int = 1) -> Column:
    return F.sum(F.col("n") * weight)


def cell_avg(weight: Column | int = 1) -> Column:
    return F.try_divide(F.sum(F.col("total") * weight), F.sum(F.col("n_value") * weight))
