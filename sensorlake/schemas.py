"""Explicit schemas of every layer."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype(), True) for name, dtype in fields])


_READING = (
    ("sensor_id", IntegerType),
    ("event_date", DateType),
    ("ts", TimestampType),
    ("reading_id", StringType),
    ("sensor_type", StringType),
    ("value", DoubleType),
    ("raw_level", StringType),
)
_INGEST = (("_extracted_at", TimestampType), ("_source", StringType))

READINGS = _struct(*_READING)
# operational documents: the time still is text and may be malformed
LANDING = _struct(*[(n, StringType if n == "ts" else t) for n, t in _READING], ("_id", StringType))
BRONZE = _struct(
    *[(n, StringType if n == "ts" else t) for n, t in _READING],
    *_INGEST,
    ("_id", StringType),
    ("ingest_batch", StringType),
)
SILVER = _struct(*_READING, *_INGEST, ("level", StringType))

SENSOR_LIFECYCLE = _struct(
    ("sensor_id", IntegerType),
    ("sensor_type", StringType),
    ("valid_from", TimestampType),
    ("valid_to", TimestampType),
    ("replacement_id", IntegerType),
)
DIM_TIME = _struct(
    ("hour_key", LongType),
    ("ts", TimestampType),
    ("year", LongType),
    ("month", LongType),
    ("day", LongType),
    ("hour", LongType),
    ("weekday", StringType),
    ("date", DateType),
    ("minute", LongType),
    ("is_weekend", BooleanType),
    ("is_holiday", BooleanType),
)
DIM_SENSOR = _struct(("sensor_id", IntegerType), ("sensor_type", StringType), ("sensor_key", IntegerType))
FACT_READINGS = _struct(
    ("sensor_key", IntegerType), ("hour_key", LongType), ("value", DoubleType), ("level", StringType)
)
DIM_ALERT = _struct(
    ("sensor_type", StringType),
    ("level", StringType),
    ("lo", DoubleType),
    ("hi", DoubleType),
    ("threshold", StringType),
    ("action", StringType),
)

# the columns that make two readings the same reading, whenever they were extracted
BUSINESS_COLUMNS = tuple(name for name, _ in _READING)

GOLD = {"dim_time": DIM_TIME, "dim_sensor": DIM_SENSOR, "fact_readings": FACT_READINGS}
