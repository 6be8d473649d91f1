"""Bronze to silver: every step is lazy and usable with ``df.transform``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.levels import classify_fixed
from ..functions.text import normalized
from ..functions.timeparts import parse_ts
from ..schemas import BUSINESS_COLUMNS

CRITICAL_COLUMNS = ("sensor_id", "ts", "value")


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def drop_critical_nulls(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """Drop rows with NULL or NaN in any of ``columns``."""
    kinds = dict(df.dtypes)
    for name in columns:
        # one comparison per column, which reaches the Parquet scan
        df = df.where(F.col(name).isNotNull())
        if kinds[name] in ("float", "double"):
            df = df.where(~F.isnan(name))
    return df


def drop_negative(df: DataFrame, column: str = "value") -> DataFrame:
    return df.where(F.col(column) >= 0)


def normalize_text(df: DataFrame, null_text: str | None = None) -> DataFrame:
    return df.withColumns({
        "sensor_type": normalized(F.col("sensor_type"), "lower", null_text),
        "raw_level": normalized(F.col("raw_level"), "upper", null_text),
    })


def dedupe(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per key; with no keys, rows must agree in every column to be copies.

    This is a grouped aggregate, so the copies of one row collapse inside each
    task before anything is shuffled and a row repeated a billion times costs
    one row per task. Of the columns outside the key the smallest combination
    is kept, in their order: with the extraction time first that is the first
    sighting with its source, whatever order the tasks run in.
    """
    if keys is None:
        return df.distinct()
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*[F.col(f"_kept.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def prepare(bronze: DataFrame, null_text: str | None = None) -> DataFrame:
    """The row-wise part of the cleaning; holds no state, so it also runs on a stream."""
    df = drop_if_present(bronze, "_id", "ingest_batch")
    df = df.withColumn("ts", parse_ts(df, "ts"))
    return drop_negative(normalize_text(drop_critical_nulls(df), null_text))


def with_level(df: DataFrame) -> DataFrame:
    return df.withColumn("level", classify_fixed(F.col("value")))


def first_sightings(prepared: DataFrame, include_metadata: bool = False) -> DataFrame:
    """Prepared rows without copies; of equal readings the one extracted first."""
    # the reading id first: where the aggregate has to sort, the first column decides most comparisons
    keys = None if include_metadata else ["reading_id", *[c for c in BUSINESS_COLUMNS if c != "reading_id"]]
    return dedupe(prepared, keys)


def clean(bronze: DataFrame, null_text: str | None = None, include_metadata: bool = False) -> DataFrame:
    """Bronze to silver without the final sort, which is a property of the written files.

    Copies are found after text normalisation, so rows that differ only in case
    or padding collapse. By default the extraction columns do not make two rows
    different; ``include_metadata`` compares them too.
    """
    # the level follows from the value, so it need not travel through the shuffle
    return with_level(first_sightings(prepare(bronze, null_text), include_metadata))
