"""The driver's tables in the shape of sensor data, and the lake built from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.operators.asof import Slices, slice_versions
from sensorlake.operators.cleaning import clean
from sensorlake.operators.lifecycle import ServiceIndex, sensor_calendar, service_counts, service_index
from sensorlake.operators.scd import change_points, scd2_build
from sensorlake.operators.star import build_time_dim
from sensorlake.plans import jobs
from sensorlake.session import SPLIT_BYTES, shared_dir, sized_for
from sensorlake.sources import lake
from sensorlake.sources.history import merge_into, read_points
from sensorlake.sources.landing import write_bronze
from sensorlake.sources.paths import fingerprint, size
from sensorlake.streaming.streams import stream_readings

TYPES = ("temperatura", "presion", "vibracion", "nivel_agua")

# the driver's tables, as far as the queries need them
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def type_of(key: str) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in TYPES]), (F.col(key) % 4 + 1).cast("int"))


def as_readings(events: DataFrame) -> DataFrame:
    """Events as raw readings: users are sensors."""
    kind = F.col("event_type")
    return events.select(
        F.col("user_id").cast("int").alias("sensor_id"),
        F.to_date("ts").alias("event_date"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").cast("string").alias("reading_id"),
        type_of("user_id").alias("sensor_type"),
        "value",
        F.when(kind == "error", " critica ").when(kind == "purchase", "Advertencia")
        .when(kind == "signup", F.lit(None)).otherwise("normal").alias("raw_level"),
    )


def as_dirty_bronze(events: DataFrame) -> DataFrame:
    """Bronze with faults: bad times, missing and negative values, padding, repeated extractions."""
    def hit(n: int) -> Column:
        return F.col("reading_id").cast("bigint") % n == 0

    copies = F.when(hit(50), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return as_readings(events).select(
        F.when(~hit(101), F.col("sensor_id")).alias("sensor_id"),
        "event_date",
        F.when(hit(103), "not-a-date").otherwise(F.col("ts").cast("string")).alias("ts"),
        "reading_id",
        F.when(hit(7), F.concat(F.lit("\t"), F.upper("sensor_type"), F.lit(" \n")))
        .otherwise(F.col("sensor_type")).alias("sensor_type"),
        F.when(hit(97), -F.col("value")).when(~hit(89), F.col("value")).alias("value"),
        "raw_level",
        F.concat(F.lit("doc-"), "reading_id").alias("_id"),
        F.explode(copies).alias("_copy"),
    ).select(
        "*",
        F.when(F.col("_copy") == 0, F.lit("2024-02-01 00:00:00")).otherwise("2024-02-02 00:00:00")
        .cast("timestamp").alias("_extracted_at"),
        F.lit("landing").alias("_source"),
    ).drop("_copy")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(load(spark, sf_dir, "events"))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_dirty_bronze(load(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # a pattern, because a stream takes a single file only where a pattern matches it
    return stream_readings(spark, f"{sf_dir}/events.parque[t]", "parquet", SCHEMAS["events"])


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as readings over seven years: suppliers are sensors."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("sensor_id"),
        F.to_date("l_shipdate").alias("event_date"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("reading_id"),
        type_of("l_suppkey").alias("sensor_type"),
        (F.col("l_quantity") * 2).alias("value"),
        F.lit(None).cast("string").alias("raw_level"),
    )


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as sensors: one starts every hour, those with an even key end mid-January."""
    key = F.col("s_suppkey")
    even = key % 2 == 0
    return load(spark, sf_dir, "supplier").select(
        key.cast("int").alias("sensor_id"), type_of("s_suppkey").alias("sensor_type"),
        F.timestamp_add("HOUR", key, F.lit("2024-01-01").cast("timestamp")).alias("valid_from"),
        F.when(even, F.lit("2024-01-15 06:00:00").cast("timestamp")).alias("valid_to"),
        F.when(even, (key + 1).cast("int")).alias("replacement_id"),
    )


def sensor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as sensors whose type changes when they are refitted at the end of their first service."""
    life = lifecycle(spark, sf_dir)
    refit = life.where("valid_to > valid_from").select(
        "sensor_id", F.concat(F.lit("refit-"), "sensor_type").alias("sensor_type"), F.col("valid_to").alias("effective"))
    return life.select("sensor_id", "sensor_type", F.col("valid_from").alias("effective")).unionByName(refit).withColumn(
        "change_id", F.unix_seconds("effective"))


def replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as sensors in chains of ten; the last chain of each hundred is a circle."""
    key = F.col("s_suppkey").cast("int")
    following = F.when(key % 10 != 0, key + 1).when(key % 100 == 0, key - 9)
    return load(spark, sf_dir, "supplier").select(key.alias("sensor_id"), following.alias("replacement_id"))


def turbines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("sensor_id"), F.col("s_nationkey").alias("turbine_id"))


def priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a change history: the customer's attribute is the priority of the last order."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("timestamp").alias("effective"), F.col("o_orderkey").alias("change_id"))


class Lake:
    """Layers and tables derived from one data folder, each written once and then read.

    A changed input file gives another ``Lake``, so nothing stale is read.
    """

    _known: dict[tuple, "Lake"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.root = f"{shared_dir(spark)}/lake-{uuid.uuid4().hex}"
        self._written: set[str] = set()
        self._made: dict[str, object] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Lake":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        key = (spark.sparkContext.applicationId, sf_dir, fingerprint(spark, f"{sf_dir}/*.parquet"))
        return cls._known.setdefault(key, cls(spark, sf_dir))

    def scratch(self, name: str) -> str:
        """A new folder for a query's own files."""
        return f"{self.root}/{name}-{uuid.uuid4().hex}"

    def _once(self, name: str, write: Callable[[str], object]) -> str:
        path = f"{self.root}/{name}"
        if name not in self._written:
            write(path)
            self._written.add(name)
        return path

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = self._once(name, lambda p: build().write.mode("overwrite").parquet(p))
        return self.spark.read.parquet(path)

    def _kept(self, name: str, build: Callable[[], object]) -> object:
        """What is made of several written tables, once."""
        if name not in self._made:
            self._made[name] = build()
        return self._made[name]

    # --- event lake: dirty bronze, silver, gold at both grains ---

    def bronze(self) -> str:
        return self._once("bronze", lambda p: write_bronze(bronze(self.spark, self.sf_dir), p, "20240201_0000"))

    def silver(self) -> DataFrame:
        path = self._once("silver", lambda p: jobs.refine(self.spark, self.bronze(), p))
        return lake.read_silver(self.spark, path)

    def silver_by_batch(self) -> DataFrame:
        def build(path: str) -> None:
            both = bronze(self.spark, self.sf_dir)
            later = F.col("_extracted_at") >= F.lit("2024-02-02").cast("timestamp")
            batches = self.scratch("bronze_batches")
            for name, rows in (("20240202_0000", both.where(later)), ("20240201_0000", both.where(~later))):
                write_bronze(rows, batches, name)
                jobs.refine_batch(self.spark, batches, path, name)

        return lake.read_silver(self.spark, self._once("silver_by_batch", build))

    def gold_by_batch(self, name: str) -> DataFrame:
        def build(path: str) -> None:
            both = bronze(self.spark, self.sf_dir)
            third = F.col("reading_id").cast("bigint") % 3 == 0
            source = self.scratch("gold_bronze")
            for batch, rows in (("b/1", both.where(~third)), ("b/2", both.where(third))):
                write_bronze(rows, source, batch)
            silver = self.scratch("gold_silver")
            for batch in ("b/2", "b/1", "b/2"):
                jobs.gold_batch(self.spark, source, silver, path, batch, self.sensor_versions())

        return lake.read(self.spark, self._once("gold_by_batch", build), name)

    def gold(self, name: str) -> DataFrame:
        def build(path: str) -> None:
            self.silver()
            jobs.build_gold(self.spark, f"{self.root}/silver", path)

        return lake.read(self.spark, self._once("gold", build), name)

    def dim_time_reading(self) -> DataFrame:
        return self.table("dim_time_reading", lambda: build_time_dim(self.silver(), "reading"))

    # --- shipment lake: the same star over seven years ---

    def long_gold_path(self) -> str:
        def build(path: str) -> None:
            with sized_for(self.spark, size(self.spark, f"{self.sf_dir}/lineitem.parquet"), SPLIT_BYTES):
                silver = self._once("long_silver", lambda p: lake.write_silver(
                    clean(shipments(self.spark, self.sf_dir)), p, sort="ts"))
            jobs.build_gold(self.spark, silver, path)

        return self._once("long_gold", build)

    def long_gold(self, name: str) -> DataFrame:
        return lake.read(self.spark, self.long_gold_path(), name)

    def long_silver(self) -> DataFrame:
        self.long_gold_path()
        return self.spark.read.parquet(f"{self.root}/long_silver")

    # --- tables whose written size decides how they are joined ---

    def calendar(self) -> DataFrame:
        return self.table("calendar", lambda: sensor_calendar(
            lifecycle(self.spark, self.sf_dir), self.gold("dim_time")))

    def versions(self) -> DataFrame:
        return self.table("versions", lambda: scd2_build(
            priorities(self.spark, self.sf_dir), "customer", ["priority"], "effective", "change_id"))

    def version_slices(self) -> Slices:
        return self._kept("version_slices", lambda: slice_versions(self.versions(), "customer"))

    def service_slices(self) -> Slices:
        return self._kept("service_slices", lambda: slice_versions(self.table(
            "service_counts", lambda: service_counts(lifecycle(self.spark, self.sf_dir))), "sensor_type"))

    def service_index(self) -> ServiceIndex:
        return self._kept("service_index", lambda: service_index(lifecycle(self.spark, self.sf_dir)))

    # --- change points: two thirds of all orders, then two merges, the later half of the orders first ---

    def first_points(self) -> DataFrame:
        return self.table("first_points", lambda: change_points(
            priorities(self.spark, self.sf_dir).where("change_id % 3 <> 0"), "customer", ["priority"], "effective", "change_id"))

    def merged_points(self) -> DataFrame:
        def build(path: str) -> None:
            self.first_points().withColumn("bucket", F.pmod(F.xxhash64("customer"), F.lit(8)).cast("int")).write.partitionBy(
                "bucket").parquet(path)
            rest = priorities(self.spark, self.sf_dir).where("change_id % 3 = 0")
            for half in (1, 0):
                merge_into(self.spark, path, rest.where(F.col("change_id") % 2 == half), "customer", ["priority"], "effective",
                           "change_id", buckets=8)

        return read_points(self.spark, self._once("merged_points", build))

    def sensor_versions(self) -> DataFrame:
        return self.table("sensor_versions", lambda: scd2_build(
            sensor_history(self.spark, self.sf_dir), "sensor_id", ["sensor_type"], "effective", "change_id"))
