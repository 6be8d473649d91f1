"""Time keys and calendar attributes as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_FULL_DATE = r"^\s*[0-9]{4,6}-[0-9]{1,2}-[0-9]{1,2}(?:[ T].*)?\s*$"


def parse_ts(df: DataFrame, name: str, strict: bool = False) -> Column:
    """The column as TIMESTAMP; text that is no full date, or is no time, becomes NULL unless ``strict``.

    Spark would complete a time without date with the current day, and a year
    with its first day; such text is no time of a reading.
    """
    if dict(df.dtypes)[name] != "string":
        return F.col(name).cast("timestamp")
    if strict:
        return F.to_timestamp(name)
    return F.when(F.col(name).rlike(_FULL_DATE), F.try_to_timestamp(F.col(name)))


def hour_key(ts: Column) -> Column:
    """yyyymmddHH as BIGINT, by integer arithmetic so it stays in generated code."""
    year = F.year(ts).cast("bigint")
    return year * 1_000_000 + F.month(ts) * 10_000 + F.day(ts) * 100 + F.hour(ts)


def hour_key_between(key: Column, year: int, month: int | None = None) -> Column:
    """Rows of one year or month as a range on the stored key.

    The key grows with time, so this predicate reaches the Parquet scan and
    skips row groups, which a predicate on a joined date part cannot.
    """
    first, last = (1, 12) if month is None else (month, month)
    return key.between(F.lit(year * 1_000_000 + first * 10_000).cast("bigint"),
                       F.lit(year * 1_000_000 + last * 10_000 + 9_999).cast("bigint"))


def date_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts).cast("bigint"),
        "month": F.month(ts).cast("bigint"),
        "day": F.day(ts).cast("bigint"),
        "hour": F.hour(ts).cast("bigint"),
    }


def weekday(ts: Column) -> Column:
    """'0' for Sunday to '6' for Saturday."""
    return (F.dayofweek(ts) - 1).cast("string")


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def with_calendar(df: DataFrame, ts: str = "ts", holidays: DataFrame | None = None) -> DataFrame:
    """Add date, minute, weekend and holiday attributes.

    ``holidays`` has one DATE column ``holiday``; without it no day is one.
    """
    out = df.withColumns({
        "date": F.to_date(ts),
        "minute": F.minute(ts).cast("bigint"),
        "is_weekend": F.dayofweek(ts).isin(1, 7),
    })
    if holidays is None:
        return out.withColumn("is_holiday", F.lit(False))
    days = holidays.select(F.col("holiday").alias("date")).distinct().withColumn("is_holiday", F.lit(True))
    return out.join(days, "date", "left").fillna(False, ["is_holiday"])


def utc(ts: Column, zone: str) -> Column:
    """A wall-clock time of ``zone`` as UTC."""
    return F.to_utc_timestamp(ts, zone)


def stamp(ts: Column, pattern: str = "yyyyMMdd_HHmm") -> Column:
    """A time as text fit for names of batches and files."""
    return F.date_format(ts, pattern)


def gain(before: Column, after: Column) -> Column:
    """How many times smaller ``after`` is; NULL when it is zero."""
    return F.try_divide(before, after)


def reading_uuid(*parts: Column) -> Column:
    """A reproducible id from the business key, unlike a random uuid safe under task retry."""
    return F.sha2(F.concat_ws("\x1f", *[p.cast("string") for p in parts]), 256)
