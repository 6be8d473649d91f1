"""Point-in-time joins by slices, even choice of sensors and merged histories against plain Python."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorlake.operators import asof, ordered, scd
from sensorlake.operators.lifecycle import assign_evenly, service_index
from sensorlake.schemas import SENSOR_LIFECYCLE
from sensorlake.sources.history import merge_into, read_points

START = datetime(2025, 1, 1)


def day(n: float) -> datetime:
    return START + timedelta(days=n)


# --- slices

VERSIONS = "k int, v int, valid_from timestamp, valid_to timestamp"


def _versions(seed: int) -> list[tuple]:
    rng, out = random.Random(seed), []
    for k in range(30):
        n = 900 if k == 3 else rng.randint(1, 6)  # one key has most of the changes
        at = sorted(rng.sample(range(100_000), n + 1))
        for i in range(n):
            if rng.random() < 0.9:  # gaps
                out.append((k, k * 1000 + i, day(at[i] / 500), None if i == n - 1 and k % 2 else day(at[i + 1] / 500)))
    # a thousand changes within a second, and ranges without any time
    out += [(50, i, day(40) + timedelta(milliseconds=i), day(40) + timedelta(milliseconds=i + 1)) for i in range(1000)]
    return out + [(1, -1, day(7), day(7)), (None, 5, day(0), None), (2, -2, None, day(9))]


def _expected(facts, versions):
    by_key = {}
    for k, v, lo, hi in versions:
        if k is not None and lo is not None:
            by_key.setdefault(k, []).append((lo, hi, v))
    return {i: next((v for lo, hi, v in by_key.get(k, []) if t is not None and lo <= t and (hi is None or t < hi)), None)
            for i, k, t in facts}


@pytest.mark.parametrize("crowd", [4, 256, 10_000])
def test_slices_equal_a_search(spark, monkeypatch, crowd):
    monkeypatch.setattr(asof, "CROWD", crowd)
    versions, rng = _versions(1), random.Random(2)
    facts = [(i, rng.choice([3, 3, 50, 99, None, *range(30)]), day(rng.uniform(-3, 210))) for i in range(4000)]
    facts += [(5000 + i, 50, day(40) + timedelta(milliseconds=i / 2)) for i in range(2100)] + [(8000, 3, None)]
    facts += [(9000 + i, k, lo) for i, (k, _, lo, _) in enumerate(versions)]
    fact, dim = spark.createDataFrame(facts, "i int, k int, t timestamp"), spark.createDataFrame(versions, VERSIONS)
    sliced = asof.slice_versions(dim, "k")
    assert sliced.crowded == (crowd < 1000) and sliced.hot is not None
    expected = _expected(facts, versions)
    left = scd.join_as_of(fact, sliced, "k", "t", "left")
    assert left.columns == ["i", "k", "t", "v", "valid_from", "valid_to"]
    assert {r["i"]: r["v"] for r in left.collect()} == expected and left.count() == len(facts)
    inner = scd.join_as_of(fact, dim, "k", "t")
    assert {r["i"]: r["v"] for r in inner.collect()} == {i: v for i, v in expected.items() if v is not None}


def test_the_listing_grows_with_the_versions(spark):
    for n in (400, 1600):
        rows = [(i % 20, i, day(i), day(i + 20)) for i in range(n)] + [(99, i, day(i / 8), day((i + 1) / 8)) for i in range(n)]
        sliced = asof.slice_versions(spark.createDataFrame(rows, VERSIONS), "k")
        assert sliced.listed.agg(F.sum(F.size("_found"))).first()[0] < 4 * len(rows)
        assert sliced.listed.agg(F.max(F.size("_found"))).first()[0] <= asof.CROWD


def test_readings_stay_where_they_are(spark):
    """Against a written listing of moderate size, readings are neither sorted, shuffled nor written."""
    sliced = asof.slice_versions(spark.createDataFrame(_versions(3)[:-1003], VERSIONS), "k")
    fact = spark.range(100_000).select((F.col("id") % 40).cast("int").alias("k"), F.timestamp_seconds(F.col("id") * 100 + 1735689600).alias("t"))
    plan = scd.join_as_of(fact, sliced, "k", "t")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert not any(word in plan for word in ("Sort", "hashpartitioning", "rangepartitioning", "Scan ExistingRDD"))


# --- even choice

def _life(n: int, seed: int) -> list[tuple]:
    rng, out = random.Random(seed), []
    for i in range(n):
        lo = day(rng.randint(0, 40) / 2)
        out.append((i, rng.choice("tp"), lo, rng.choice([None, lo, lo + timedelta(days=rng.randint(1, 30) / 2)]), None))
    return out + [(9000, None, day(0), None, None), (9001, "t", None, None, None)]


def test_every_choice_is_in_service_and_each_number_finds_another_sensor(spark):
    life = _life(150, 4)
    index = service_index(spark.createDataFrame(life, SENSOR_LIFECYCLE))
    times = [(t, day(i / 4 - 2)) for i in range(150) for t in ("t", "p", "none")] + [(None, day(3)), ("t", None)]
    rows = [(i, j, kind, ts) for i, (kind, ts) in enumerate(times) for j in range(160)]
    readings = spark.createDataFrame(rows, "i int, j int, sensor_type string, ts timestamp")
    got = assign_evenly(readings, index, F.col("j")).collect()
    assert len(got) == len(rows)
    found: dict = {}
    for r in got:
        found.setdefault(r["i"], []).append((r["j"], r["assigned_id"], r["n_active"]))
    for i, (kind, ts) in enumerate(times):
        valid = sorted(s for s, k, lo, hi, _ in life
                       if kind is not None and ts is not None and k == kind and lo is not None and lo <= ts and (hi is None or ts < hi))
        assert {n for _, _, n in found[i]} == {len(valid)}
        # the numbers 0 to n - 1 are the sensors in service, each once; larger ones go round
        first = [s for j, s, _ in sorted(found[i]) if j < len(valid)]
        assert sorted(first) == valid
        assert all(s == (first[j % len(valid)] if valid else None) for j, s, _ in found[i])


def test_a_fleet_replaced_in_one_instant_shares_readings_evenly(spark):
    life = [(i, "t", day(0), day(9), None) for i in range(3000)] + [(3000 + i, "t", day(9), None, None) for i in range(1000)]
    index = service_index(spark.createDataFrame(life, SENSOR_LIFECYCLE))
    readings = spark.range(80_000).select(
        F.col("id"), F.lit("t").alias("sensor_type"), F.lit(day(10)).cast("timestamp").alias("ts"))
    pick = F.xxhash64("id")
    out = assign_evenly(readings, index, pick)
    counts = Counter(r["assigned_id"] for r in out.select("assigned_id").collect())
    assert set(counts) == set(range(3000, 4000))
    assert max(counts.values()) < 80 + 5 * 80 ** 0.5 and min(counts.values()) > 80 - 5 * 80 ** 0.5
    again = assign_evenly(readings.repartition(5), service_index(spark.createDataFrame(life[::-1], SENSOR_LIFECYCLE)), pick)
    assert again.exceptAll(out).isEmpty()
    assert index.segments.listed.select(F.max(F.size(F.flatten("_found.runs")))).first()[0] < 40


def test_no_sensors(spark):
    index = service_index(spark.createDataFrame([], SENSOR_LIFECYCLE))
    rows = spark.createDataFrame([(1, "t", day(0))], "i int, sensor_type string, ts timestamp")
    assert [(r["n_active"], r["assigned_id"]) for r in assign_evenly(rows, index, F.col("i")).collect()] == [(0, None)]


# --- merged histories

HISTORY = "k int, attr string, at timestamp, id int"


def _ranges(rows):
    out = {}
    for k in {r[0] for r in rows}:
        last = {at: attr for _, attr, at, _ in sorted((r for r in rows if r[0] == k), key=lambda r: (r[2], r[3]))}
        kept = []
        for at, attr in sorted(last.items()):
            if not kept or kept[-1][1] != attr:
                kept.append((at, attr))
        for n, (at, attr) in enumerate(kept):
            out[k, at] = (attr, kept[n + 1][0] if n + 1 < len(kept) else None)
    return out


def _read(versions):
    rows = versions.collect()
    assert all(r["is_active"] == (r["valid_to"] is None) for r in rows)
    assert len({r["version_key"] for r in rows}) == len(rows)
    return {(r["k"], r["valid_from"]): (r["attr"], r["valid_to"]) for r in rows}


def _history(seed: int, n: int = 500) -> list[tuple]:
    rng = random.Random(seed)
    return [(0 if rng.random() < 0.33 else rng.randint(1, 12), rng.choice(["a", "b", None]), day(rng.randint(0, 90)), i) for i in range(n)]


def test_a_late_state_between_two_equal_ones(spark):
    frame = lambda rows: spark.createDataFrame(rows, HISTORY)
    points = scd.change_points(frame([(1, "b", day(0), 1), (1, "b", day(60), 2)]), "k", ["attr"], "at", "id")
    assert _read(scd.versions_of(points, "k", ["attr"], "at")) == {(1, day(0)): ("b", None)}
    merged = scd.merge_points(points, frame([(1, "c", day(30), 3)]), "k", ["attr"], "at", "id")
    versions = scd.versions_of(merged, "k", ["attr"], "at")
    assert _read(versions) == {(1, day(0)): ("b", day(30)), (1, day(30)): ("c", day(60)), (1, day(60)): ("b", None)}
    assert [r["version_key"] for r in versions.orderBy("valid_from").collect()] == [1, 3, 2]


@pytest.mark.parametrize("part", [1 << 20, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_merges_in_any_split_and_order_equal_one_build(spark, monkeypatch, seed, part):
    monkeypatch.setattr(ordered, "PART", part)  # keys cut into parts change nothing
    rows = _history(seed)
    built = scd.scd2_build(spark.createDataFrame(rows, HISTORY), "k", ["attr"], "at", "id")
    assert _read(built) == _ranges(rows)
    random.Random(seed).shuffle(rows)
    pieces = [rows[:150], rows[150:160], rows[160:400], rows[400:]]
    points = scd.change_points(spark.createDataFrame(pieces[0], HISTORY), "k", ["attr"], "at", "id")
    owner = {r["version_key"]: r["k"] for r in scd.versions_of(points, "k", ["attr"], "at").collect()}
    for n, piece in enumerate(pieces[1:], 2):
        points = scd.merge_points(points, spark.createDataFrame(piece, HISTORY), "k", ["attr"], "at", "id")
        versions = scd.versions_of(points, "k", ["attr"], "at")
        assert _read(versions) == _ranges([r for p in pieces[:n] for r in p])
        now = {r["version_key"]: r["k"] for r in versions.collect()}
        assert all(owner.get(number, k) == k for number, k in now.items())
        owner |= now


def test_the_store_rewrites_the_buckets_of_updated_keys_only(spark, tmp_path):
    path, rows = str(tmp_path / "points"), _history(7)
    frame = lambda part: spark.createDataFrame(part, HISTORY)
    merge_into(spark, path, frame(rows[:300]), "k", ["attr"], "at", "id", buckets=8)
    files = lambda: {(f.parent.name, f.name) for f in (tmp_path / "points").rglob("*.parquet")}
    before = files()
    update = [r for r in rows[300:] if r[0] in (0, 5)]
    touched = merge_into(spark, path, frame(update), "k", ["attr"], "at", "id", buckets=8)
    assert 1 <= len(touched) <= 2
    assert {bucket for bucket, _ in before - files()} == {f"bucket={b}" for b in touched}
    merged = [*rows[:300], *update]
    assert _read(scd.versions_of(read_points(spark, path), "k", ["attr"], "at")) == _ranges(merged)
    numbers = {(r["k"], r["at"]): r["version_key"] for r in read_points(spark, path).collect()}
    merge_into(spark, path, frame(update), "k", ["attr"], "at", "id", buckets=8)  # once more
    assert {(r["k"], r["at"]): r["version_key"] for r in read_points(spark, path).collect()} == numbers


def test_intermediate_tables_go_at_the_end(spark, tmp_path, monkeypatch):
    from sensorlake import session

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path / "shared"))
    kept = session.written(spark.range(3), "numbers")
    assert kept.count() == 3 and any((tmp_path / "shared").iterdir())
    session.drop_intermediate(spark)
    assert not (tmp_path / "shared").exists()
