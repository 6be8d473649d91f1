import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sensorlake.operators.cleaning import clean, dedupe, drop_if_present, first_sightings, prepare, with_level
from sensorlake.operators.rollups import hourly_cells
from sensorlake.plans import jobs
from sensorlake.schemas import BRONZE, READINGS
from sensorlake.session import sized_for
from sensorlake.sources import batches, lake, paths
from sensorlake.sources.landing import append_readings, read_bronze, read_landing, read_readings, with_ingest_metadata, write_bronze

FIRST, SECOND = datetime(2025, 6, 1, 10), datetime(2025, 6, 2, 10)


def bronze(spark, *rows):
    """Rows as overrides of one good bronze row."""
    good = {
        "sensor_id": 101, "event_date": date(2025, 6, 1), "ts": "2025-06-01 08:30:00", "reading_id": "r1",
        "sensor_type": "presion", "value": 30.0, "raw_level": "NORMAL", "_extracted_at": FIRST, "_source": "api",
        "_id": "d1", "ingest_batch": "b1",
    }
    return spark.createDataFrame([tuple({**good, **r}[f.name] for f in BRONZE) for r in rows], BRONZE)


@pytest.mark.parametrize("value, level", [
    (0.0, "NORMAL"), (60.0, "NORMAL"), (60.01, "ADVERTENCIA"), (80.0, "ADVERTENCIA"), (80.01, "CRITICA")])
def test_levels_use_strict_thresholds(spark, value, level):
    assert clean(bronze(spark, {"value": value})).first()["level"] == level


@pytest.mark.parametrize("bad", [
    {"value": -0.01}, {"value": None}, {"value": float("nan")}, {"sensor_id": None}, {"ts": None}, {"ts": "31/31/2025"}])
def test_bad_rows_are_dropped(spark, bad):
    assert clean(bronze(spark, bad, {})).count() == 1


def test_text_is_stripped_and_folded(spark):
    row = clean(bronze(spark, {"sensor_type": "\tPresion \n", "raw_level": " critica\r"})).first()
    assert (row["sensor_type"], row["raw_level"]) == ("presion", "CRITICA")


def test_missing_text(spark):
    missing = {"sensor_type": None, "raw_level": None}
    row = clean(bronze(spark, missing)).first()
    assert row["sensor_type"] is None and row["raw_level"] is None
    row = clean(bronze(spark, missing), null_text="None").first()
    assert (row["sensor_type"], row["raw_level"]) == ("none", "NONE")


def test_rows_equal_after_normalising_collapse(spark):
    assert clean(bronze(spark, {"sensor_type": " PRESION"}, {"_id": "d2"})).count() == 1


def test_second_extraction_is_a_copy_unless_metadata_counts(spark):
    rows = bronze(spark, {"_extracted_at": SECOND, "_source": "another"}, {})
    kept = clean(rows).collect()
    assert [(r["_extracted_at"], r["_source"]) for r in kept] == [(FIRST, "api")]
    # where the extraction columns are not read, they are not aggregated either
    assert "min(" not in clean(rows).select("reading_id", "level")._jdf.queryExecution().optimizedPlan().toString()
    assert clean(rows, include_metadata=True).count() == 2


def test_cleaning_is_idempotent(spark):
    once = clean(bronze(spark, {}, {"value": 70.0, "reading_id": "r2"}, {"sensor_type": " X "}))
    assert sorted(clean(once.drop("level")).collect()) == sorted(once.collect())


def test_copies_collapse_before_the_shuffle(spark):
    """A row that is a third of the input leaves each task once."""
    df = spark.range(0, 30000, 1, 4).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    plan = dedupe(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2
    assert dedupe(df).count() == 20001


def test_time_sorted_files(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [{"reading_id": str(i), "ts": f"2025-06-01 08:{(i * 37) % 60:02d}:00"} for i in range(200)]
    lake.write_silver(clean(bronze(spark, *rows)), path, sort="ts", partitions=4)
    files = (
        lake.read_silver(spark, path).groupBy(F.input_file_name().alias("f"))
        .agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).orderBy("f").collect())
    assert len(files) > 1
    assert all(a["hi"] <= b["lo"] for a, b in zip(files, files[1:]))
    assert lake.read_silver(spark, path).count() == 200


def test_bronze_batches_of_different_columns(spark, tmp_path):
    root = str(tmp_path / "bronze")
    full = bronze(spark, {}).drop("ingest_batch", "_extracted_at", "_source")
    write_bronze(with_ingest_metadata(full, "api"), root, "20250601_1000")
    write_bronze(with_ingest_metadata(full.drop("raw_level", "_id"), "file"), root, "20250602_1000")
    for schema in (BRONZE, None):
        rows = {r["_source"]: r for r in read_bronze(spark, root, schema).collect()}
        assert rows["file"]["raw_level"] is None and rows["api"]["raw_level"] == "NORMAL"
        assert rows["api"]["ingest_batch"] == "20250601_1000"
        assert all(r["_extracted_at"] is not None for r in rows.values())


def test_no_bronze_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_bronze(spark, str(tmp_path))


def test_malformed_documents(spark, tmp_path):
    (tmp_path / "docs.json").write_text(
        '{"sensor_id": 1, "value": 2.5, "extra": 1}\n{"sensor_id": "x", "value": 3.5}\n{"sensor_id": 3}\n')
    rows = read_landing(spark, str(tmp_path)).select("sensor_id", "value").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, 2.5), (None, 3.5), (3, None)], key=str)


def test_drop_if_present(spark):
    df = spark.range(1).withColumn("_id", F.lit(1))
    assert drop_if_present(df, "_id", "absent").columns == ["id"]


def test_silver_in_date_folders(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [{"reading_id": str(i), "ts": f"2025-06-0{1 + i % 3} 08:00:00", "event_date": date(2025, 6, 1 + i % 3)}
            for i in range(30)]
    lake.write_silver(clean(bronze(spark, *rows)), path, sort="ts", partition_by=["event_date"])
    june2 = lake.read_silver(spark, path).where(F.col("event_date") == date(2025, 6, 2))
    assert june2.count() == 10
    assert "PartitionFilters: [isnotnull(event_date" in june2._jdf.queryExecution().executedPlan().toString()


def test_task_sizes_follow_the_input_and_are_restored(spark):
    confs = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(c) for c in confs]
    with sized_for(spark, 10 << 30):
        assert int(spark.conf.get(confs[0])) == 80
    with sized_for(spark, 100 << 40):
        assert int(spark.conf.get(confs[0])) == 100 << 13
    assert [spark.conf.get(c) for c in confs] == before


def test_rows_of_a_scan_task_are_bounded_while_copies_collapse(spark):
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    with sized_for(spark, 10 << 30, 32 << 20):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 320
        assert int(spark.conf.get(conf)) == 32 << 20
    assert spark.conf.get(conf) == before


def test_a_lake_is_made_anew_when_a_file_is_rewritten_and_not_when_it_is_read(spark, tmp_path):
    file = tmp_path / "a.parquet"
    file.write_bytes(b"1")
    os.utime(file, (1_000, 2_000))
    first = paths.fingerprint(spark, f"{tmp_path}/*.parquet")
    os.utime(file, (3_000, 2_000))  # as a read does
    assert paths.fingerprint(spark, f"{tmp_path}/*.parquet") == first
    os.utime(file, (3_000, 4_000))
    assert paths.fingerprint(spark, f"{tmp_path}/*.parquet") != first


def test_silver_by_batch_equals_silver_of_all(spark, tmp_path):
    day2 = {"event_date": date(2025, 6, 2), "ts": "2025-06-02 09:00:00"}
    first = bronze(spark, {}, {"reading_id": "r2"}, {"reading_id": "r3", **day2}, {"reading_id": "r4", "event_date": None},
                   {"value": None, "reading_id": "r5"})
    late = {"_extracted_at": SECOND, "_source": "late"}
    second = bronze(spark, late, {"reading_id": "r6", **late}, {"reading_id": "r4", "event_date": None, **late},
                    {"reading_id": "r7", "event_date": None, **late})
    whole, root = str(tmp_path / "whole"), str(tmp_path / "bronze")
    for name, rows in (("b1", first), ("b2", second)):
        write_bronze(rows, root, name)
    jobs.refine(spark, root, whole)
    expected = sorted(map(str, lake.read_silver(spark, whole).collect()))
    assert len(expected) == 6
    for order in (("b1", "b2"), ("b2", "b1"), ("b1", "b2", "b1")):
        silver = str(tmp_path / "-".join(order))
        for name in order:
            jobs.refine_batch(spark, root, silver, name)
        columns = lake.read_silver(spark, whole).columns
        assert sorted(map(str, lake.read_silver(spark, silver).select(*columns).collect())) == expected


def test_rows_dealt_by_day_are_joined_to_copies_and_cells_without_a_second_shuffle(spark):
    rows = prepare(bronze(spark, {}, {"reading_id": "r2"}, {}))
    single = first_sightings(lake.by_day(rows))
    assert single._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert single.count() == 2
    cells = hourly_cells(with_level(rows), lambda r: lake.by_day(r, sort=("hour", "sensor_id")))
    assert cells._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert cells.select("readings", "total").collect() == [(3, 90.0)]


def test_an_extraction_that_runs_again_leaves_one_copy(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for name in ("2025", "a/b=c %é", "2025"):  # names that look like numbers, or need quoting in a path
        write_bronze(bronze(spark, {"reading_id": name}, {"reading_id": "r2"}), root, name)
    rows = read_bronze(spark, root).collect()
    assert sorted((r["ingest_batch"], r["reading_id"]) for r in rows) == sorted(
        [("2025", "2025"), ("2025", "r2"), ("a/b=c %é", "a/b=c %é"), ("a/b=c %é", "r2")])
    assert batches.complete(spark, root) == ["2025", "a/b=c %é"]
    # the second time there is less, or nothing at all
    write_bronze(bronze(spark, {"reading_id": "r9"}), root, "2025")
    assert {r["reading_id"] for r in read_bronze(spark, root).where("ingest_batch = '2025'").collect()} == {"r9"}
    write_bronze(bronze(spark, {}).limit(0), root, "2025")
    assert read_bronze(spark, root).where("ingest_batch = '2025'").count() == 0


def test_a_batch_that_is_lost_half_way_is_not_read(spark, tmp_path):
    root = str(tmp_path / "bronze")
    write_bronze(bronze(spark, {}), root, "good")
    write_bronze(bronze(spark, {}, {"reading_id": "r2"}), root, "lost")
    batches.unmark(spark, root, "lost")  # as while it is written again
    assert {r["ingest_batch"] for r in read_bronze(spark, root).collect()} == {"good"}
    failing = bronze(spark, {}).withColumn("value", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        write_bronze(failing, root, "good")
    with pytest.raises(FileNotFoundError):
        read_bronze(spark, root)
    write_bronze(bronze(spark, {}), root, "good")
    assert read_bronze(spark, root).count() == 1


def test_loads_of_readings_are_appended_once(spark, tmp_path):
    path = str(tmp_path / "readings")
    assert read_readings(spark, path, READINGS).count() == 0
    rows = spark.createDataFrame([(1, None, None, "r", "t", 1.0, None)], READINGS)
    for load in ("1", "2", "1"):
        append_readings(rows, path, load)
    assert read_readings(spark, path, READINGS).schema == READINGS
    assert read_readings(spark, path, READINGS).count() == 2


def test_insert_absent_reads_only_keys_in_the_range(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(1000).selectExpr("id AS k", "'old' AS v").repartitionByRange(4, "k").write.parquet(path)
    rows = spark.createDataFrame([(995, "new"), (1001, "b"), (1001, "a"), (1002, "c"), (None, "d")], "k bigint, v string")
    plan = lake.incoming_range(spark, rows, path, "k")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,995)" in plan and "LessThanOrEqual(k,1002)" in plan and "ReadSchema: struct<k:bigint>" in plan
    assert sorted(map(tuple, lake.insert_absent_into(rows.where("k IS NOT NULL"), path, "k").collect())) == [(1001, "b"), (1002, "c")]
    assert lake.insert_absent_into(rows.where("k IS NOT NULL"), path, "k").count() == 0
    assert spark.read.parquet(path).count() == 1002
    assert lake.insert_absent_into(rows.where("k IS NOT NULL"), str(tmp_path / "new"), "k").count() == 3


def _star(spark, gold):
    fact, sensor, time = (lake.read(spark, gold, n) for n in ("fact_readings", "dim_sensor", "dim_time"))
    keys = [r[0] for r in sensor.select("sensor_key").collect()]
    assert len(keys) == len(set(keys)) and time.count() == time.select("hour_key").distinct().count()
    rows = fact.join(sensor, "sensor_key").join(time, "hour_key").select(
        "sensor_id", "sensor_type", "ts", "value", "level").collect()
    return sorted(map(str, rows))


def test_gold_by_batch_equals_gold_of_all(spark, tmp_path):
    day2 = {"event_date": date(2025, 6, 2), "ts": "2025-06-02 09:00:00"}
    late = {"_extracted_at": SECOND, "_source": "late"}
    first = bronze(spark, {}, {"reading_id": "r2", "sensor_id": 7}, {"reading_id": "r3", **day2}, {"reading_id": "r4", "event_date": None})
    second = bronze(spark, late, {"reading_id": "r6", "sensor_id": 3, **late}, {"reading_id": "r4", "event_date": None, **late},
                    {"reading_id": "r8", "sensor_id": 7, **day2, **late}, {"reading_id": "r9", "sensor_type": None, **late})
    root, whole = str(tmp_path / "bronze"), str(tmp_path / "whole")
    for name, rows in (("b1", first), ("b2", second)):
        write_bronze(rows, root, name)
    jobs.refine(spark, root, f"{whole}/silver")
    jobs.build_gold(spark, f"{whole}/silver", f"{whole}/gold")
    expected = _star(spark, f"{whole}/gold")
    assert len(expected) >= 6
    versions = spark.createDataFrame([(7, datetime(2025, 6, 2), None, 5)], "sensor_id int, valid_from timestamp, valid_to timestamp, version_key bigint")
    for order in (("b1", "b2"), ("b2", "b1"), ("b1", "b2", "b1")):
        at = str(tmp_path / "-".join(order))
        for n, name in enumerate(order):
            assert (name in jobs.pending(spark, root, f"{at}/gold")) == (n < 2)
            jobs.gold_batch(spark, root, f"{at}/silver", f"{at}/gold", name, versions)
        assert jobs.pending(spark, root, f"{at}/gold") == []
        assert _star(spark, f"{at}/gold") == expected
        by_version = spark.read.parquet(f"{at}/gold/fact_versions")
        assert by_version.count() == len(expected) and by_version.where("version_key = 5").count() == 1
