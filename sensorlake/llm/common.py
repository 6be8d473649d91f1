"""What the operators of this package share: reading tables, stored intermediate tables, word patterns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_ROWS = 500
_BATCH_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers at most ``_BATCH_ROWS`` and ``_BATCH_BYTES`` at a time; results do not depend on it.

    A batch lies in memory four times: in Spark's buffers and in the worker, on the
    way in and on the way out. Spark's own 10,000 rows are meant for numbers. The
    setting holds for the session, as lazy frames are planned when they run.
    """
    rows = int(spark.conf.get(_BATCH_CONF))
    if rows <= 0 or rows > _BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(_BATCH_ROWS))
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_BYTES_CONF))
    if size <= 0 or size > _BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES_CONF, str(_BATCH_BYTES))


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the one that all executors share."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back; ``options`` go to the writer.

    Cuts the lineage and pins one outcome: later steps read files of known
    size, also after an executor is lost.
    """
    path = new_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def no_null(text: Column) -> Column:
    """Text without NULL: a missing text is an empty one."""
    return F.coalesce(text, F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
