"""Silver and gold tables: writing, reading, layout and profile."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.scd import insert_absent
from ..schemas import GOLD, SILVER
from ..session import written
from .paths import holds_file

GOLD_TABLES = tuple(GOLD)


def write_silver(df: DataFrame, path: str, sort: str | None = None, partitions: int | None = None,
                 partition_by: Sequence[str] = ()) -> None:
    """Write silver, in ascending order of ``sort`` across and within the files.

    The other columns break ties in the range partitioning, so even a single
    instant with very many readings is spread over several files. With
    ``partition_by=["event_date"]`` filters on the day skip whole folders; a
    task covers a stretch of time and so writes into few of them.
    """
    if sort is not None:
        order = [sort, *[c for c in ("sensor_id", "reading_id") if c in df.columns and c != sort]]
        ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
        df = ranged.sortWithinPartitions(*order)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


_IN_DAYS = ("ts", "sensor_id", "reading_id")


def by_day(df: DataFrame, day: str = "event_date", sort: Sequence[str] = _IN_DAYS) -> DataFrame:
    """``df`` dealt by ranges of ``day`` and ``sort``."""
    return df.repartitionByRange(day, *sort)


def write_days(df: DataFrame, path: str, day: str = "event_date", sort: Sequence[str] = _IN_DAYS) -> None:
    """Write ``df``, which comes from ``by_day``, in folders by ``day``, over the folders of the days that it holds; other days stay.

    Old folders are removed once all new files are written, so ``df`` may read from ``path``.
    """
    (df.sortWithinPartitions(day, *sort).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path))


def replace_days(df: DataFrame, path: str, day: str = "event_date", sort: Sequence[str] = _IN_DAYS) -> None:
    """``write_days`` of any ``df``."""
    write_days(by_day(df, day, sort), path, day, sort)


def insert_absent_into(rows: DataFrame, path: str, key: str) -> DataFrame:
    """Append the ``rows`` whose key the table at ``path`` lacks, one per key, and return those.

    Of the table only the key is read, within the range of the incoming keys:
    the range is pushed to the scan, where files and row groups outside it are
    skipped. The append becomes visible as a whole; run again after a failure
    it adds what is still missing.
    """
    spark = rows.sparkSession
    rows = written(rows, "incoming")
    new = insert_absent(incoming_range(spark, rows, path, key), rows, key) if holds_file(spark, path, ".parquet") \
        else insert_absent(rows.limit(0), rows, key)
    new = written(new, "absent")
    new.write.mode("append").parquet(path)
    return new


def incoming_range(spark: SparkSession, rows: DataFrame, path: str, key: str) -> DataFrame:
    """The keys of the table at ``path`` that lie within the range of the keys of ``rows``."""
    least, most = rows.agg(F.min(key), F.max(key)).first()
    known = spark.read.parquet(path).select(key)
    return known.where(F.col(key).between(F.lit(least), F.lit(most))) if least is not None else known.limit(0)


def write_gold(tables: Mapping[str, DataFrame], root: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def read(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A table of the lake; the gold tables have a known schema, so no file is opened to plan a scan."""
    schema = schema or GOLD.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{root}/{name}")


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SILVER).parquet(path)


def register_views(spark: SparkSession, root: str, names: Sequence[str] = GOLD_TABLES) -> None:
    for name in names:
        read(spark, root, name).createOrReplaceTempView(name)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def cluster_fact(spark: SparkSession, source: str, target: str, by: str = "hour_key",
                 row_group_bytes: int = 128 << 20, partitions: int | None = None) -> DataFrame:
    """Rewrite a table sorted by ``by`` with bounded row groups and return it.

    Row groups then cover disjoint ranges, and a filter on ``by`` skips the
    others. The row's place in its source file breaks ties, so one hour with a
    third of all rows still fills many files. Unlike a random number that place
    is the same when a lost task runs again. ``target`` must not be ``source``.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("a table cannot be rewritten onto itself")
    df = spark.read.parquet(source)
    place = {"_row": F.col("_metadata.row_index"), "_file": F.col("_metadata.file_path")}
    placed = df.select(*df.columns, *[c.alias(name) for name, c in place.items()])
    order = [by, "_row", "_file"]
    ranged = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    (ranged.sortWithinPartitions(by).drop("_row", "_file").write.mode("overwrite")
     .option("parquet.block.size", row_group_bytes).parquet(target))
    return spark.read.parquet(target)


def align_key_types(dim: DataFrame, fact: DataFrame, keys: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Cast the ``keys`` (column to type) on both sides where they occur.

    With equal types the join needs no cast; narrowing raises on overflow.
    """
    def cast(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c).cast(t) for c, t in keys.items() if c in df.columns})

    return cast(dim), cast(fact)


def profile_tables(spark: SparkSession, root: str, names: Sequence[str] = GOLD_TABLES) -> DataFrame:
    """One row per table and column: row count, position, name and type."""
    def profile(name: str) -> DataFrame:
        # the schema of the files, not the declared one
        df = spark.read.parquet(f"{root}/{name}")
        columns = F.array(*[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type"))
            for i, (c, t) in enumerate(df.dtypes, 1)])
        return df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.explode(columns).alias("c")).select("table", "rows", "c.*")

    return reduce(DataFrame.unionAll, [profile(name) for name in names])
