"""Changing dimensions, sensor lifecycle and episodes against plain Python."""

import random
import re
from datetime import datetime, timedelta
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import episodes, ordered, scd
from sensorlake.operators.dimensions import build_alert_dim, build_turbine_dim
from sensorlake.operators.episodes import anomaly_episodes
from sensorlake.operators.lifecycle import (
    active_sensors, assign_sensor, last_successor, replacement_of, sensor_calendar, service_counts)
from sensorlake.operators.star import build_versioned_fact
from sensorlake.schemas import SENSOR_LIFECYCLE
from sensorlake.sources.history import merge_into, read_points

START = datetime(2025, 1, 1)


def day(n: float) -> datetime:
    return START + timedelta(days=n)


# --- versions ---

def expected_versions(rows):
    out = []
    for key, changes in groupby(sorted(rows, key=lambda r: (r[0], r[2], r[3])), key=lambda r: r[0]):
        last = {when: attr for _, attr, when, _ in changes}
        kept = []
        for when, attr in sorted(last.items()):
            if not kept or kept[-1][1] != attr:
                kept.append((when, attr))
        ends = [w for w, _ in kept[1:]] + [None]
        out += [(key, attr, when, end, end is None) for (when, attr), end in zip(kept, ends)]
    return out


@pytest.fixture(scope="module")
def history():
    rng = random.Random(5)
    # key 0 has a third of all changes
    return [(0 if rng.random() < 0.33 else rng.randint(1, 40), rng.choice(["a", "b", None]), day(rng.randint(0, 400)), i)
            for i in range(3000)]


def test_scd2_build(spark, history):
    df = spark.createDataFrame(history, "k int, attr string, at timestamp, id int")
    rows = scd.scd2_build(df, "k", ["attr"], "at", "id").orderBy("version_key").collect()
    got = [(r["k"], r["attr"], r["valid_from"], r["valid_to"], r["is_active"]) for r in rows]
    assert got == expected_versions(history)
    assert [r["version_key"] for r in rows] == list(range(1, len(rows) + 1))
    active = [r["k"] for r in rows if r["is_active"]]
    assert len(active) == len(set(active)) == 41


def test_scd2_merge_cases(spark):
    first = spark.createDataFrame([
        (1, "a", day(0), 1), (1, "b", day(5), 2), (2, "a", day(0), 3), (3, None, day(0), 4), (5, "q", day(0), 5),
    ], "k int, attr string, at timestamp, id int")
    updates = spark.createDataFrame([
        (1, "d", day(9), 11), (1, "c", day(10), 12), (1, "z", day(2), 16),  # two in order and a late one
        (2, "a", day(10), 13), (3, None, day(10), 14),  # nothing changes
        (4, "x", day(10), 15),  # new key
        (5, "old", day(0), 0),  # known better already
    ], "k int, attr string, at timestamp, id int")
    points = scd.merge_points(scd.change_points(first, "k", ["attr"], "at", "id"), updates, "k", ["attr"], "at", "id")
    rows = scd.versions_of(points, "k", ["attr"], "at").orderBy("k", "valid_from").collect()
    assert [tuple(r[c] for c in ("k", "attr", "valid_from", "valid_to", "is_active", "version_key")) for r in rows] == [
        (1, "a", day(0), day(2), False, 1), (1, "z", day(2), day(5), False, 6), (1, "b", day(5), day(9), False, 2),
        (1, "d", day(9), day(10), False, 7), (1, "c", day(10), None, True, 8), (2, "a", day(0), None, True, 3),
        (3, None, day(0), None, True, 4), (4, "x", day(10), None, True, 11), (5, "q", day(0), None, True, 5)]


def test_scd2_merge_into_empty_points(spark):
    none = spark.createDataFrame([], "k int, at timestamp, attr string, id int, version_key bigint")
    updates = spark.createDataFrame([(7, "x", day(1), 1)], "k int, attr string, at timestamp, id int")
    row = scd.versions_of(scd.merge_points(none, updates, "k", ["attr"], "at", "id"), "k", ["attr"], "at").collect()
    assert [(r["k"], r["version_key"], r["is_active"]) for r in row] == [(7, 1, True)]


def test_a_merge_is_computed_once_and_its_versions_without_a_join(spark, history):
    df = spark.createDataFrame(history, "k int, attr string, at timestamp, id int")
    points = scd.change_points(df.where("id % 3 <> 0"), "k", ["attr"], "at", "id")
    merged = scd.merge_points(points, df.where("id % 3 = 0"), "k", ["attr"], "at", "id")
    assert "max_by" not in merged._jdf.queryExecution().optimizedPlan().toString()
    versions = scd.versions_of(merged, "k", ["attr"], "at")
    joins = [df._jdf.queryExecution().optimizedPlan().toString().count("Join ") for df in (merged, versions)]
    assert joins[0] == joins[1]
    got = [tuple(r[c] for c in ("k", "attr", "valid_from", "valid_to", "is_active")) for r in versions.orderBy("k", "valid_from").collect()]
    assert got == expected_versions(history)


@pytest.mark.parametrize("part", [1, 1 << 20])
def test_numbered_versions_leave_out_a_missing_key(spark, monkeypatch, part):
    monkeypatch.setattr(ordered, "PART", part)
    rows = [(1, day(0), "a", 1), (1, day(1), "b", 2), (None, day(0), "c", 3)]
    points = spark.createDataFrame(rows, "k int, at timestamp, attr string, version_key bigint")
    found = scd.versions_of(points, "k", ["attr"], "at").orderBy("version_key").collect()
    assert [(r["k"], r["attr"], r["version_key"]) for r in found] == [(1, "a", 1), (1, "b", 2)]


def test_stored_points_are_rewritten_in_few_files(spark, history, tmp_path):
    df, path = spark.createDataFrame(history, "k int, attr string, at timestamp, id int"), str(tmp_path / "points")
    for third in (1, 2, 0):
        merge_into(spark, path, df.where(F.col("id") % 3 == third), "k", ["attr"], "at", "id", buckets=4)
    points = read_points(spark, path)
    assert points.where(F.col("bucket") != F.pmod(F.xxhash64("k"), F.lit(4))).isEmpty()
    files = points.select(F.input_file_name()).distinct().count()
    assert files <= 4 * 2 + 8  # new points of a bucket in one, known ones where ranges end
    versions = scd.versions_of(points, "k", ["attr"], "at").orderBy("k", "valid_from").collect()
    got = [tuple(r[c] for c in ("k", "attr", "valid_from", "valid_to", "is_active")) for r in versions]
    assert got == expected_versions(history)
    assert points.select("version_key").distinct().count() == points.count()


@pytest.mark.parametrize("way", [{}, {"few": True}, {"cell": "month"}, {"cell": "day"}])
def test_join_as_of(spark, history, way):
    df = spark.createDataFrame(history, "k int, attr string, at timestamp, id int")
    versions = scd.scd2_build(df, "k", ["attr"], "at", "id")
    facts = [(i, i % 45, day((i * 7) % 450 - 10)) for i in range(900)]
    expected = sorted(
        (i, str(attr)) for i, k, t in facts for key, attr, lo, hi, _ in expected_versions(history)
        if key == k and lo <= t and (hi is None or t < hi))
    fact = spark.createDataFrame(facts, "i int, k int, t timestamp")
    joined = scd.join_as_of(fact, versions, "k", "t", **way)
    assert sorted((r["i"], str(r["attr"])) for r in joined.collect()) == expected
    left = scd.join_as_of(fact, versions, "k", "t", how="left", **way)
    assert left.count() == len(facts)


def test_join_as_of_with_a_hot_key_missing_values_and_empty_ranges(spark):
    versions = spark.createDataFrame(
        [(1, i, day(i), day(i + 1)) for i in range(300)] + [(1, -1, day(5), day(5)), (2, 7, day(0), day(2)), (3, 8, day(50), None)],
        "k int, v int, valid_from timestamp, valid_to timestamp")
    rows = [(i, 1, day(i % 302)) for i in range(3000)] + [
        (-1, 2, day(1)), (-2, 2, day(2)), (-3, 3, day(49)), (-4, 3, day(50)), (-5, None, day(60)), (-6, 3, None), (-7, 4, day(60))]
    fact = spark.createDataFrame(rows, "i int, k int, t timestamp").repartition(16)
    got = {r["i"]: r["v"] for r in scd.join_as_of(fact, versions, "k", "t", "left").collect()}
    expected = {i: i % 302 if i % 302 < 300 else None for i in range(3000)}
    assert got == expected | {-1: 7, -2: None, -3: None, -4: 8, -5: None, -6: None, -7: None}
    assert scd.join_as_of(fact, versions, "k", "t").count() == sum(v is not None for v in got.values())
    assert scd.join_as_of(fact, versions.limit(0), "k", "t", "left").count() == len(rows)
    assert scd.join_as_of(fact.limit(0), versions, "k", "t").count() == 0
    with pytest.raises(ValueError):
        scd.join_as_of(fact, versions, "k", "t", "full")


def test_versioned_fact(spark):
    versions = spark.createDataFrame(
        [(1, day(2), day(5), 11), (1, day(5), None, 12)], "sensor_id int, valid_from timestamp, valid_to timestamp, version_key bigint")
    silver = spark.createDataFrame(
        [(1, day(1), 0.0, "a"), (1, day(2), 1.0, "a"), (1, day(5), 2.0, "a"), (2, day(5), 3.0, "a")],
        "sensor_id int, ts timestamp, value double, level string")
    assert {r["value"]: r["version_key"] for r in build_versioned_fact(silver, versions).collect()} == {0: 0, 1: 11, 2: 12, 3: 0}


def test_upsert_insert_and_union(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, n int")
    full = dim.withColumn("n", F.lit(0))
    assert sorted(map(tuple, scd.scd1_upsert(full, new, "k", ["n"]).collect())) == [(1, "a", 0), (2, "d", 2), (3, "e", 1)]
    assert sorted(map(tuple, scd.insert_absent(full, new.union(new), "k").collect())) == [(3, "e", 1)]
    both = scd.union_by_name(dim, new.drop("v"))
    assert both.columns == ["k", "v", "n"] and both.where("v is null").count() == 3


# --- lifecycle ---

LIFE = [
    (101, "t", day(0), day(10.5), 201), (201, "t", day(10.5), None, None), (105, "t", day(3), None, None),
    (102, "p", day(0), day(20), 202), (202, "p", day(20), None, None), (300, "p", day(40), day(40), None),
]


@pytest.mark.parametrize("cell", ["hour", "day", "month"])
def test_sensors_in_service(spark, cell):
    life = spark.createDataFrame(LIFE, SENSOR_LIFECYCLE)
    rows = [(i, kind, day(i / 4 - 1)) for i in range(120) for kind in ("t", "p", "unknown")]
    readings = spark.createDataFrame(rows, "i int, sensor_type string, ts timestamp")
    calendar = sensor_calendar(life, readings, cell)
    counted = {(r["i"], r["sensor_type"]): r["n_active"] for r in active_sensors(readings, service_counts(life)).collect()}
    chosen = {(r["i"], r["sensor_type"]): r["assigned_id"] for r in assign_sensor(readings, calendar, cell).collect()}
    for i, kind, t in rows:
        valid = [s for s, k, lo, hi, _ in LIFE if k == kind and lo <= t and (hi is None or t < hi)]
        assert counted[i, kind] == len(valid)
        assert chosen[i, kind] == (min(valid) if valid else None)


def test_a_fleet_that_is_replaced_in_one_hour(spark):
    life = [(i, "t", day(0), day(9.5), 1000 + i) for i in range(1000)] + [(1000 + i, "t", day(9.5), None, None) for i in range(900)]
    counts = service_counts(spark.createDataFrame(life + [(5000, None, day(0), None, None)], SENSOR_LIFECYCLE))
    assert sorted((r["valid_from"], r["valid_to"], r["n_active"]) for r in counts.collect()) == [
        (day(0), day(9.5), 1000), (day(9.5), None, 900)]
    assert "collect_list" not in counts._jdf.queryExecution().toString()


def test_old_sensor_ends_where_the_new_one_starts(spark):
    life = spark.createDataFrame(LIFE, SENSOR_LIFECYCLE)
    at_change = spark.createDataFrame([("t", day(10.5)), ("p", day(20))], "sensor_type string, ts timestamp")
    chosen = assign_sensor(at_change, sensor_calendar(life, at_change)).orderBy("sensor_type").collect()
    assert [r["assigned_id"] for r in chosen] == [202, 105]
    follow = {r["sensor_id"]: r["replacement_from"] for r in replacement_of(life).collect()}
    assert follow[101] == day(10.5) and follow[201] is None and len(follow) == len(LIFE)


def test_last_successor_walks_the_whole_chain_and_stops_at_circles(spark):
    follows = {i: i + 1 for i in range(1, 40)} | {40: None, 50: 51, 51: 52, 52: 50, 60: 50, 70: 999, 80: 80, 90: None}
    rows = [(s, r) for s, r in follows.items()] + [(1, 2), (1, 30), (None, 5)]
    life = spark.createDataFrame(rows, "sensor_id int, replacement_id int")
    got = {r["sensor_id"]: (r["last_id"], r["replacements"]) for r in last_successor(life).collect()}
    expected = {}
    for sensor in follows:
        at, seen = sensor, [sensor]
        while follows.get(at) is not None and follows[at] not in seen:
            at = follows[at]
            seen.append(at)
        circle = follows.get(at) is not None
        expected[sensor] = (None, None) if circle else (at, len(seen) - 1)
    assert got == expected
    assert last_successor(life.limit(0)).count() == 0


# --- episodes ---

def expected_episodes(rows):
    out = []
    for sensor, own in groupby(sorted(rows, key=lambda r: (r[0], r[1], r[2])), key=lambda r: r[0]):
        for alert, run in groupby(own, key=lambda r: r[4] != "NORMAL"):
            run = list(run)
            if alert:
                out.append((sensor, run[0][1], run[-1][1], len(run), max(r[3] for r in run),
                            (run[-1][1] - run[0][1]).total_seconds()))
    return out


@pytest.mark.parametrize("cell", ["minute", "hour", "month", None])
def test_episodes(spark, cell):
    rng = random.Random(11)
    rows = []
    for i in range(4000):
        sensor = 0 if rng.random() < 0.4 else rng.randint(1, 9)
        value = float(rng.randint(0, 100))
        # runs long enough to cross many cells, and readings that share a time
        level = "CRITICA" if value > (10 if sensor < 3 else 60) else "NORMAL"
        rows.append((sensor, day(rng.randint(0, 2000) / 24), f"{i:05d}", value, level))
    df = spark.createDataFrame(rows, "sensor_id int, ts timestamp, reading_id string, value double, level string")
    out = anomaly_episodes(df, cell).select("sensor_id", "start_ts", "end_ts", "readings", "max_value", "duration_s")
    assert sorted(map(tuple, out.collect())) == expected_episodes(rows)


def test_a_sensor_with_many_readings_is_cut_into_parts(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(0 if i % 3 else i % 7, day(rng.randint(0, 3000) / 24), f"{i:05d}", float(i), rng.choice(["NORMAL", "CRITICA"])) for i in range(3000)]
    df = spark.createDataFrame(rows, "sensor_id int, ts timestamp, reading_id string, value double, level string")
    monkeypatch.setattr(ordered, "PART", 100)
    parts, by = ordered.in_parts(df, "sensor_id", "ts")
    assert by == ["sensor_id", "_part"]
    assert parts.groupBy(*by).count().agg(F.max("count")).first()[0] < 300
    out = anomaly_episodes(df).select("sensor_id", "start_ts", "end_ts", "readings", "max_value", "duration_s")
    assert sorted(map(tuple, out.collect())) == expected_episodes(rows)
    plan = anomaly_episodes(df)._jdf.queryExecution().optimizedPlan().toString()
    assert all("sensor_id" in line and "_part" in line for line in plan.splitlines() if "Window [" in line and "reading_id" in line)


def test_episodes_by_cell_sort_within_a_cell_only(spark):
    df = spark.createDataFrame([], "sensor_id int, ts timestamp, reading_id string, value double, level string")
    plan = anomaly_episodes(df, "hour")._jdf.queryExecution().optimizedPlan().toString()
    by_cell = [line for line in plan.splitlines() if "Window [" in line]
    assert len(by_cell) == 2
    assert sum("reading_id" in line for line in by_cell) == 1
    assert all("cell" in line for line in by_cell)


def test_rows_of_an_episode_task_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(episodes, "TASK_ROWS", 10)
    df = spark.range(1005).select(
        (F.col("id") % 7).cast("int").alias("sensor_id"), F.timestamp_seconds(F.col("id") * 86400).alias("ts"),
        F.col("id").cast("string").alias("reading_id"), F.lit(1.0).alias("value"), F.lit("CRITICA").alias("level"))
    plan = episodes.anomaly_episodes(df, "month")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(sensor_id#\d+, cell#\d+, 101\)", plan)) == 2


# --- small dimensions ---

def test_alert_and_turbine_dimensions(spark):
    alert = build_alert_dim(spark)
    assert alert.count() == 12
    assert alert.where("sensor_type = 'presion' and level = 'CRITICA'").first()["threshold"] == "60-80"
    t = spark.createDataFrame(
        [(2, "B", 5, "on"), (1, "A", 5, "on"), (1, "A", 5, "on")], "turbine_id int, name string, capacity int, state string")
    assert [(r["turbine_id"], r["turbine_key"]) for r in build_turbine_dim(t).orderBy("turbine_id").collect()] == [(1, 1), (2, 2)]
