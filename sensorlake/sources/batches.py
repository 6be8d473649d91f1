"""Tables that grow by whole batches: a batch is replaced when it is written again, and read once it is complete.

A batch lies in a folder of its own and has a marker in ``_batches``, which is
taken away before the folder is touched and put back when it is whole. Readers
go by the markers, so a batch that was lost half-way is not read, and writing it
again leaves one copy.
"""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import paths

MARKS = "_batches"


def mark(spark: SparkSession, root: str, batch: str) -> None:
    paths.touch(spark, f"{root}/{MARKS}/{quote(batch, safe='')}.done")


def unmark(spark: SparkSession, root: str, batch: str) -> None:
    paths.remove(spark, f"{root}/{MARKS}/{quote(batch, safe='')}.done")


def complete(spark: SparkSession, root: str) -> list[str]:
    """The batches whose writing has ended."""
    return [unquote(name.removesuffix(".done")) for name in paths.names(spark, f"{root}/{MARKS}/*.done")]


def write_batch(df: DataFrame, root: str, batch: str, column: str = "ingest_batch") -> None:
    """Write ``df`` as the folder ``<column>=<batch>``, in place of what is there; nothing is shuffled."""
    spark = df.sparkSession
    unmark(spark, root, batch)
    # of an empty frame there is no folder to replace, so an earlier copy has to go beforehand
    paths.remove(spark, folder(spark, root, batch, column))
    (df.withColumn(column, F.lit(batch)).write.partitionBy(column).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(root))
    mark(spark, root, batch)


def folder(spark: SparkSession, root: str, batch: str, column: str = "ingest_batch") -> str:
    """The folder of a batch, named as Spark names it."""
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch)
    return f"{root}/{column}={name}"
