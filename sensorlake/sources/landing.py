"""Operational documents to bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import BRONZE, LANDING
from .batches import complete, write_batch
from .paths import holds_file


def read_landing(spark: SparkSession, path: str, fmt: str = "json", schema: StructType = LANDING,
                 **options: str) -> DataFrame:
    """All documents of a collection as a typed frame; ``fmt`` may be any installed connector."""
    reader = spark.read.format(fmt).schema(schema).options(**options)
    if fmt in ("json", "csv"):
        reader = reader.option("mode", "PERMISSIVE")
    return reader.load(path)


def with_ingest_metadata(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"_extracted_at": F.current_timestamp(), "_source": F.lit(source)})


def write_bronze(df: DataFrame, root: str, batch: str) -> None:
    """Write one extraction as partition ``ingest_batch=<batch>``; an extraction that is run again replaces its copy."""
    write_batch(df, root, batch)


def read_bronze(spark: SparkSession, root: str, schema: StructType | None = BRONZE) -> DataFrame:
    """All complete extractions; a column an extraction lacks is NULL. A lake without any is an error.

    With a schema no footer has to be read to plan the scan; ``schema=None``
    merges the schemas found in the files.
    """
    done = complete(spark, root)
    if not done or not holds_file(spark, root, ".parquet"):
        raise FileNotFoundError(f"no bronze files under {root}")
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    return reader.parquet(root).where(F.col("ingest_batch").cast("string").isin(done))


def append_readings(df: DataFrame, path: str, load: str) -> None:
    """Append one load of readings; the same load written again, say after a failure, leaves one copy."""
    write_batch(df, path, load, "load")


def read_readings(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The readings of all complete loads; none if there is no load yet."""
    done = complete(spark, path)
    if not done:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema, StructField("load", StringType())])).parquet(path)
    return rows.where(F.col("load").isin(done)).drop("load")
