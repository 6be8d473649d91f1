"""Change points of a slowly changing dimension, stored by key bucket; its versions are a view of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scd import change_points, merged_parts
from .paths import holds_file

BUCKETS = 64


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn("bucket", _bucket(key, buckets))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merge_into(spark: SparkSession, path: str, updates: DataFrame, key: str, attrs: Sequence[str], effective: str, tie: str,
               buckets: int = BUCKETS) -> list[int]:
    """Merge updates into the stored change points at ``path`` and return the buckets that were rewritten.

    Only buckets of updated keys are read, staged apart, in the order of the
    buckets, and swapped in; of them only new points are shuffled once more. A
    merge that is lost on the way may be run again with the same updates: points
    that are already there keep their numbers and the rest follows.
    """
    if not holds_file(spark, path, ".parquet"):
        points = change_points(updates, key, attrs, effective, tie)
        _bucketed(points, key, buckets).write.partitionBy("bucket").mode("overwrite").parquet(path)
        return list(range(buckets))
    stored = read_points(spark, path)
    # at most as many numbers as there are buckets
    touched = sorted(r.bucket for r in _bucketed(updates.select(key), key, buckets).select("bucket").distinct().collect())
    highest = stored.agg(F.max("version_key")).scalar()
    known, new = merged_parts(
        stored.where(F.col("bucket").isin(touched)).drop("bucket"), updates, key, attrs, effective, tie, highest=highest,
        bucket=_bucket(key, buckets))
    # neither reads from ``path``: the merge is written apart and the numbers of new points are pinned
    (known.unionByName(new.repartition("bucket")).select(*stored.columns).write.partitionBy("bucket").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    return touched
