"""Complete jobs from layer to layer. Layers are written tables, so each job reads files of known size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import clean, first_sightings, prepare, with_level
from ..operators.quality import quality_report
from ..operators.rollups import hourly_cells
from ..operators.star import build_fact, build_sensor_dim, build_time_dim, build_versioned_fact, extend_sensor_dim
from ..session import sized_for, written
from ..sources import batches, lake
from ..sources.landing import read_bronze, read_landing, with_ingest_metadata, write_bronze
from ..sources.paths import holds_file, size


def ingest(spark: SparkSession, landing: str, bronze: str, batch: str, source: str, **read_options) -> None:
    """Landing documents to one bronze batch."""
    write_bronze(with_ingest_metadata(read_landing(spark, landing, **read_options), source), bronze, batch)


def refine(spark: SparkSession, bronze: str, silver: str, partition_by: tuple[str, ...] = (),
           **clean_options) -> DataFrame:
    """Bronze to time-sorted silver; returns the quality report."""
    raw = read_bronze(spark, bronze)
    with sized_for(spark, size(spark, bronze)):
        lake.write_silver(clean(raw, **clean_options), silver, sort="ts", partition_by=partition_by)
    return quality_report(raw, lake.read_silver(spark, silver))


def refine_batch(spark: SparkSession, bronze: str, silver: str, batch: str, null_text: str | None = None,
                 include_metadata: bool = False) -> None:
    """Bring one bronze batch into silver that lies in folders by day.

    Copies agree in their day, so only the folders of the batch's days are read
    and replaced. Batches may come in any order and may be brought in again: the
    result is the same as of one ``refine`` over all of them.

    The batch's own copies collapse before they are shuffled. What is known has
    none, so each reading comes twice at most when both are dealt in the order
    of the files; the second copy goes there, without another shuffle. The old
    folders are replaced when all new ones are written; if a job is lost while
    it replaces them, bronze still holds all rows.
    """
    batch_rows = prepare(read_bronze(spark, bronze).where(F.col("ingest_batch") == batch), null_text)
    rows = first_sightings(batch_rows, include_metadata)
    with sized_for(spark, size(spark, f"{bronze}/ingest_batch={batch}")):
        if holds_file(spark, silver, ".parquet"):
            known = lake.read_silver(spark, silver).drop("level")
            days = batch_rows.select("event_date").distinct()
            # rows without a day lie in a folder of their own
            rows = rows.unionByName(known.join(days, "event_date", "left_semi")).unionByName(known.where("event_date IS NULL"))
            rows = first_sightings(lake.by_day(rows), include_metadata)
            lake.write_days(with_level(rows), silver)
        else:
            lake.replace_days(with_level(rows), silver)


def build_gold(spark: SparkSession, silver: str, gold: str, grain: str = "hour",
               on: tuple[str, ...] = ("sensor_id", "sensor_type")) -> None:
    """Silver to the star schema.

    The dimensions are written first and the fact joins the written sensor
    dimension, so that join is planned with its real size.
    """
    readings = lake.read_silver(spark, silver)
    with sized_for(spark, size(spark, silver)):
        lake.write_gold({"dim_time": build_time_dim(readings, grain), "dim_sensor": build_sensor_dim(readings)}, gold)
        dim_sensor = lake.read(spark, gold, "dim_sensor")
        lake.write_gold({"fact_readings": build_fact(readings, dim_sensor, on)}, gold)


def gold_batch(spark: SparkSession, bronze: str, silver: str, gold: str, batch: str,
               sensor_versions: DataFrame | None = None) -> None:
    """Bring one bronze batch into silver and gold.

    Sensors and hours that the dimensions lack are appended, with keys after the
    known ones; the facts and hourly sums of the batch's days, and with
    ``sensor_versions`` the facts by sensor version, replace the day folders they lie in. The batch is
    entered in gold's list of batches when all of that is done. Every step gives
    the same when it is run again, so batches may come in any order, and one that
    was lost half-way, or is already in, may be brought in once more.
    """
    batches.unmark(spark, gold, batch)
    refine_batch(spark, bronze, silver, batch)
    rows = prepare(read_bronze(spark, bronze).where(F.col("ingest_batch") == batch))
    refresh_days(spark, silver, gold, rows.select("event_date").distinct(), sensor_versions)
    batches.mark(spark, gold, batch)


def refresh_days(spark: SparkSession, silver: str, gold: str, days: DataFrame, sensor_versions: DataFrame | None = None) -> None:
    """Make the facts of ``days`` (event_date) anew from silver, for instance after a late change of a sensor's versions."""
    days = written(days, "days")
    silver_rows = lake.read_silver(spark, silver)
    # rows without a day lie in a folder of their own
    readings = silver_rows.join(days, "event_date", "left_semi").unionByName(silver_rows.where("event_date IS NULL"))
    with sized_for(spark, size(spark, silver)):
        lake.insert_absent_into(build_time_dim(readings), f"{gold}/dim_time", "hour_key")
        sensors = f"{gold}/dim_sensor"
        if not holds_file(spark, sensors, ".parquet"):
            build_sensor_dim(readings).write.mode("overwrite").parquet(sensors)
        else:
            written(extend_sensor_dim(lake.read(spark, gold, "dim_sensor"), readings), "new_sensors").write.mode("append").parquet(sensors)
        fact = build_fact(readings, lake.read(spark, gold, "dim_sensor"), keep=["event_date"])
        lake.replace_days(fact, f"{gold}/fact_readings", sort=("hour_key", "sensor_key"))
        by_hour = {"sort": ("hour", "sensor_id")}
        cells = hourly_cells(readings, lambda rows: lake.by_day(rows, **by_hour))
        lake.write_days(cells, f"{gold}/hourly_cells", **by_hour)
        if sensor_versions is not None:
            fact = build_versioned_fact(readings, sensor_versions, keep=["event_date"])
            lake.replace_days(fact, f"{gold}/fact_versions", sort=("hour_key", "version_key"))


def pending(spark: SparkSession, bronze: str, gold: str) -> list[str]:
    """Bronze batches that are complete, but not yet in gold."""
    return sorted(set(batches.complete(spark, bronze)) - set(batches.complete(spark, gold)))


def cluster_gold(spark: SparkSession, gold: str, target: str, **layout) -> None:
    """Copy gold with the fact sorted by hour and the sensor dimension in the fact's key types."""
    source = f"{gold}/fact_readings"
    with sized_for(spark, size(spark, source)):
        fact = lake.cluster_fact(spark, source, f"{target}/fact_readings", **layout)
    key_types = {"sensor_key": dict(fact.dtypes)["sensor_key"], "sensor_id": "int"}
    dim_sensor, _ = lake.align_key_types(lake.read(spark, gold, "dim_sensor"), fact, key_types)
    lake.write_gold({"dim_time": lake.read(spark, gold, "dim_time"), "dim_sensor": dim_sensor}, target)
