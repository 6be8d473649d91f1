"""Which sensors were in service when a reading was taken."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir, written
from .asof import Slices, slice_versions
from .ordered import with_neighbour, with_position, with_running_total
from .scd import join_as_of, valid_at


def sensor_calendar(lifecycle: DataFrame, times: DataFrame, cell: str = "day") -> DataFrame:
    """Per (sensor_type, time cell) within the span of ``times.ts``: who is in service.

    ``whole_id`` is the smallest id of the sensors valid throughout the cell;
    ``parts`` lists the few that start or end within it. A sensor is in ``parts`` of at most two cells, so the calendar
    holds one row per type and cell plus two entries per sensor, however many
    readings there are. Where very many sensors of a type change on one day, a
    finer ``cell`` keeps the lists short.

    ``times`` may be the time dimension. Write the calendar and read it back
    before joining it to large data: as a file it has a known size, by which the
    join is planned.
    """
    span = times.agg(F.date_trunc(cell, F.min("ts")).alias("first"), F.date_trunc(cell, F.max("ts")).alias("last"))
    first, last = (span.select(F.col(c).cast("timestamp")).scalar() for c in ("first", "last"))
    starts, ends = F.col("valid_from").cast("timestamp"), F.col("valid_to").cast("timestamp")
    one = F.expr(f"interval 1 {cell}")
    listed = (
        lifecycle.withColumns({
            "_first": F.greatest(F.date_trunc(cell, starts), first),
            "_last": F.least(F.coalesce(F.date_trunc(cell, ends), last), last),
        }).where(F.col("_first") <= F.col("_last"))
        .withColumn("cell", F.explode(F.sequence("_first", "_last", one)))
    )
    start, end = F.col("cell"), F.col("cell") + one
    whole = (starts <= start) & (ends.isNull() | (ends >= end))
    part = ~whole & (ends.isNull() | (ends > start))
    return listed.groupBy("sensor_type", "cell").agg(
        F.min(F.when(whole, F.col("sensor_id"))).alias("whole_id"),
        F.collect_list(F.when(part, F.struct("sensor_id", starts.alias("start"), ends.alias("end")))).alias("parts"),
    )


def service_counts(lifecycle: DataFrame) -> DataFrame:
    """Per sensor_type the number of sensors in service, ``n_active``, as ranges [valid_from, valid_to).

    Starts add one and ends take one away, along type and time. A sensor still in
    service is ended after all others, so each type adds up to nothing and the
    total needs no restart between types.
    """
    start, end = F.col("valid_from").cast("timestamp"), F.col("valid_to").cast("timestamp")
    served = lifecycle.where(F.col("sensor_type").isNotNull() & start.isNotNull() & (end.isNull() | (start < end)))
    change = lambda at, n, still: F.struct(at.alias("at"), F.lit(n).alias("n"), still.alias("open_end"))
    changes = served.select("sensor_type", F.explode(F.array(
        change(start, 1, F.lit(False)), change(end, -1, end.isNull()))).alias("c")).select("sensor_type", "c.*")
    # the sum per instant first: a fleet that is replaced in one hour becomes one row in each task
    steps = changes.groupBy("sensor_type", "open_end", "at").agg(F.sum("n").alias("n"))
    counted = with_running_total(steps, ["sensor_type", "open_end", "at"], "n", "n_active").where("NOT open_end")
    numbered = with_position(counted.select("sensor_type", "at", "n_active"), ["sensor_type", "at"], "_place")
    return with_neighbour(numbered, "_place", "sensor_type", F.col("at"), "valid_to", +1).select(
        "sensor_type", F.col("at").alias("valid_from"), "valid_to", F.col("n_active").cast("bigint").alias("n_active"))


def active_sensors(readings: DataFrame, counts: DataFrame | Slices) -> DataFrame:
    """Add ``n_active``: the number of sensors of the reading's type valid at its time.

    ``counts`` comes from ``service_counts``, or from ``slice_versions`` of that
    for several joins. Readings meet a small listing of counts by type and time
    slice and are not sorted; no list of sensors is ever produced.
    """
    timed = readings.withColumn("_ts", F.col("ts").cast("timestamp"))
    return join_as_of(timed, counts, "sensor_type", "_ts", "left").select(
        *readings.columns, F.coalesce("n_active", F.lit(0).cast("bigint")).alias("n_active"))


@dataclass(frozen=True)
class ServiceIndex:
    """Who is in service at a time: ``segments`` name runs of places, ``sensors`` has the sensor of every place."""

    segments: Slices
    sensors: DataFrame


def service_index(lifecycle: DataFrame) -> ServiceIndex:
    """An index that finds the k-th sensor of a type in service at a time.

    The instants at which something changes are numbered along type and time. A
    validity is a range of these numbers and falls into O(log n) dyadic nodes,
    blocks of 2^l numbers; the members of each node have consecutive places, in
    the order of their ids. The sensors in service from one instant to the next
    are the members of the nodes above that instant, at most one a level. So no
    list of sensors is held, however many change at one instant.
    """
    start, end = F.col("valid_from").cast("timestamp"), F.col("valid_to").cast("timestamp")
    served = lifecycle.where(F.col("sensor_type").isNotNull() & start.isNotNull() & (end.isNull() | (start < end))).select(
        "sensor_id", "sensor_type", start.alias("start"), end.alias("end"))
    times = served.select("sensor_type", F.explode(F.array("start", "end")).alias("at")).where("at IS NOT NULL").distinct()
    instants = written(with_position(times, ["sensor_type", "at"], "_place"), "instants")
    ends = instants.groupBy("sensor_type").agg((F.max("_place") + 1).alias("_beyond"))
    begin = instants.select("sensor_type", F.col("at").alias("start"), F.col("_place").alias("a"))
    close = instants.select("sensor_type", F.col("at").alias("end"), F.col("_place").alias("b"))
    ranges = served.join(begin, ["sensor_type", "start"]).join(close, ["sensor_type", "end"], "left").join(ends, "sensor_type")
    ranges = ranges.select("sensor_id", "a", F.coalesce("b", "_beyond").alias("b"))
    levels = instants.count().bit_length() + 1

    def nodes(level: Column) -> Column:
        lo = F.floor((F.col("a") + F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1)
                     / F.call_function("shiftleft", F.lit(1).cast("long"), level)).cast("long")
        hi = F.call_function("shiftright", F.col("b"), level)
        node = lambda n: F.struct(level.alias("level"), n.alias("number"))
        return F.array(F.when((lo < hi) & (lo % 2 == 1), node(lo)), F.when((lo < hi) & (hi % 2 == 1), node(hi - 1)))

    every = F.sequence(F.lit(0), F.lit(levels))
    members = ranges.select("sensor_id", F.explode(F.flatten(F.transform(every, nodes))).alias("n")).where("n IS NOT NULL")
    placed = written(with_position(
        members.select("n.level", "n.number", "sensor_id"), ["level", "number", "sensor_id"], "place"), "service_members")
    runs = placed.groupBy("level", "number").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    above = instants.select("_place", F.explode(every).alias("level")).select(
        "_place", "level", F.call_function("shiftright", F.col("_place"), F.col("level")).alias("number"))
    held = above.join(runs, ["level", "number"]).groupBy("_place").agg(
        F.sort_array(F.collect_list(F.struct("first", "n"))).alias("runs"), F.sum("n").alias("n_active"))
    segments = with_neighbour(instants, "_place", "sensor_type", F.col("at"), "valid_to", +1).join(held, "_place").select(
        "sensor_type", F.col("at").alias("valid_from"), "valid_to", "n_active", "runs")
    return ServiceIndex(slice_versions(segments, "sensor_type"), placed.select("place", "sensor_id"))


def assign_evenly(readings: DataFrame, index: ServiceIndex, pick: Column) -> DataFrame:
    """Add ``n_active`` and ``assigned_id``: the sensor in service whose number is ``pick`` modulo their count.

    ``pick`` is a whole number made of the reading's own columns, such as
    ``xxhash64("reading_id")``; then each sensor in service gets an even share,
    and the same one whenever the job runs again. NULL when there is none.
    """
    timed = readings.withColumns({"_ts": F.col("ts").cast("timestamp"), "_pick": pick.cast("bigint")})
    found = join_as_of(timed, index.segments, "sensor_type", "_ts", "left")
    # along the runs: what is left of the number, and the place once a run holds it
    place = F.aggregate(
        "runs", F.struct(F.pmod("_pick", "n_active").alias("rest"), F.lit(None).cast("bigint").alias("place")),
        lambda s, r: F.struct(
            (s["rest"] - r["n"]).alias("rest"),
            F.when(s["place"].isNull() & (s["rest"] < r["n"]), r["first"] + s["rest"]).otherwise(s["place"]).alias("place")),
        lambda s: s["place"])
    placed = found.select(*readings.columns, F.coalesce("n_active", F.lit(0).cast("bigint")).alias("n_active"), place.alias("_place"))
    sensors = index.sensors.select(F.col("place").alias("_place"), F.col("sensor_id").alias("assigned_id"))
    return placed.join(sensors, "_place", "left").drop("_place")


def assign_sensor(readings: DataFrame, calendar: DataFrame, cell: str = "day") -> DataFrame:
    """Add ``assigned_id``: the valid sensor with the smallest id, NULL when there is none."""
    ts = F.col("ts").cast("timestamp")
    joined = readings.withColumn("cell", F.date_trunc(cell, ts)).join(calendar, ["sensor_type", "cell"], "left")
    valid = F.filter("parts", lambda p: valid_at(ts, p["start"], p["end"]))
    smallest = F.least(F.col("whole_id"), F.array_min(F.transform(valid, lambda p: p["sensor_id"])))
    return joined.withColumn("assigned_id", smallest).select(*readings.columns, "assigned_id")


def replacement_of(lifecycle: DataFrame) -> DataFrame:
    """Each sensor with its direct successor's type and start, NULL when it has none."""
    successor = lifecycle.select(
        F.col("sensor_id").alias("replacement_id"),
        F.col("sensor_type").alias("replacement_type"),
        F.col("valid_from").alias("replacement_from"),
    )
    return lifecycle.join(successor, "replacement_id", "left").select(
        "sensor_id", "replacement_id", "replacement_type", "replacement_from")


def last_successor(lifecycle: DataFrame) -> DataFrame:
    """Each sensor with the end of its chain of replacements, ``last_id``, and their number.

    A sensor without replacement is its own end; a successor that is not a
    sensor of ``lifecycle`` ends the chain. Where the chain runs into a circle,
    both figures are NULL. Of several replacements of a sensor the smallest
    id counts. Every round doubles the distance looked ahead, so a chain of n
    sensors takes log2(n) joins, and one row per sensor is all that is held.
    """
    shared_dir(lifecycle.sparkSession)
    ahead = lifecycle.where("sensor_id IS NOT NULL").groupBy("sensor_id").agg(F.min("replacement_id").alias("_next"))
    ahead = ahead.select(
        "sensor_id", F.coalesce("_next", "sensor_id").alias("last_id"),
        F.col("_next").isNotNull().cast("bigint").alias("replacements"), F.col("_next").isNotNull().alias("_open"),
    ).checkpoint()
    sensors, looked = ahead.count(), 1
    # a chain without a circle has no more replacements than there are sensors
    while looked <= sensors and not ahead.where("_open").isEmpty():
        on = ahead.select(
            F.col("sensor_id").alias("last_id"), F.col("last_id").alias("_last"),
            F.col("replacements").alias("_more"), F.col("_open").alias("_still"))
        further = ahead.where("_open").join(on, "last_id", "left").select(
            "sensor_id", F.coalesce("_last", "last_id").alias("last_id"),
            (F.col("replacements") + F.coalesce("_more", F.lit(0))).alias("replacements"),
            F.coalesce("_still", F.lit(False)).alias("_open"))
        ahead, looked = ahead.where("NOT _open").unionByName(further).checkpoint(), 2 * looked
    ended = lambda name: F.when(~F.col("_open"), F.col(name)).alias(name)
    return ahead.select("sensor_id", ended("last_id"), ended("replacements"))
