"""One query per operator, on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import tables as T
from registry.tables import Lake
from sensorlake.functions import levels, timeparts
from sensorlake.operators import asof, cleaning, episodes, lifecycle, quality, rollups, scd, star
from sensorlake.operators.dimensions import build_alert_dim, build_turbine_dim
from sensorlake.operators.ordered import with_position
from sensorlake.plans import jobs, reports
from sensorlake.schemas import READINGS
from sensorlake.sources import lake, landing
from sensorlake.streaming import increments, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn``: times without zone and averages to six places, as the SQL side has them.

    The 1e-9 keeps averages that end exactly half way between two values of six
    places from being decided by the order of summation.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        fixes = {c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"}
        fixes |= {c: F.round(F.col(c) + 1e-9, 6) for c, t in df.dtypes
                  if t == "double" and c.startswith(("avg_", "mean", "std", "deviation", "gain"))}
        return df.withColumns(fixes) if fixes else df

    run.__doc__, run.__name__ = fn.__doc__, fn.__name__
    QUERIES[fn.__name__] = run
    return run


def silver_of(spark, sf):
    return cleaning.clean(T.bronze(spark, sf))


def level_of_readings(spark, sf):
    return cleaning.with_level(T.readings(spark, sf))


# --- sources and sinks ---------------------------------------------------------

@query
def bronze_ingest(spark, sf):
    """Two extractions, one without levels, landed as documents and read back as one table."""
    folder = Lake.of(spark, sf)
    root, bronze = folder.scratch("landing"), folder.scratch("bronze")
    docs = T.readings(spark, sf).withColumn("ts", F.col("ts").cast("string"))
    docs.withColumn("_id", F.concat(F.lit("doc-"), "reading_id")).write.json(f"{root}/full")
    docs.drop("raw_level").write.parquet(f"{root}/narrow")
    jobs.ingest(spark, f"{root}/full", bronze, "20240201_0000", "json_landing")
    jobs.ingest(spark, f"{root}/narrow", bronze, "20240202_0000", "parquet_landing", fmt="parquet")
    jobs.ingest(spark, f"{root}/full", bronze, "20240201_0000", "json_landing")  # run again: one copy stays
    return landing.read_bronze(spark, bronze).drop("_extracted_at")


@query
def bronze_merged_schema(spark, sf):
    """Rows per extraction when the schema is merged from the files."""
    folder = Lake.of(spark, sf)
    bronze = folder.scratch("bronze")
    docs = T.readings(spark, sf)
    landing.write_bronze(landing.with_ingest_metadata(docs, "a"), bronze, "20240201_0000")
    landing.write_bronze(landing.with_ingest_metadata(docs.drop("raw_level"), "b"), bronze, "20240202_0000")
    return landing.read_bronze(spark, bronze, schema=None).groupBy("_source").agg(
        F.count("*").alias("readings"), F.count("raw_level").alias("levels"),
        F.count("_extracted_at").alias("stamped"))


@query
def append_readings(spark, sf):
    """Two loads of different sources appended to one table, one of them twice."""
    path = Lake.of(spark, sf).scratch("appended")
    loads = {"events": T.readings(spark, sf), "shipments": T.shipments(spark, sf)}
    for load in ("events", "shipments", "events"):
        landing.append_readings(loads[load], path, load)
    return landing.read_readings(spark, path, READINGS).groupBy("sensor_type", "event_date").agg(
        F.count("*").alias("readings"), F.max("value").alias("max_value"))


@query
def insert_absent(spark, sf):
    """Sensors seen in readings or shipments that the supplier list of even keys lacks."""
    known = T.lifecycle(spark, sf).where("replacement_id is not null").select("sensor_id", "sensor_type")
    seen = T.readings(spark, sf).select("sensor_id", "sensor_type").unionByName(
        T.shipments(spark, sf).select("sensor_id", "sensor_type"))
    return scd.insert_absent(known, seen, "sensor_id")


@query
def insert_absent_into(spark, sf):
    """The same in two loads into a stored table: all its rows afterwards."""
    path = Lake.of(spark, sf).scratch("sensors")
    T.lifecycle(spark, sf).where("replacement_id is not null").select("sensor_id", "sensor_type").write.parquet(path)
    for rows in (T.readings(spark, sf), T.shipments(spark, sf), T.readings(spark, sf)):
        lake.insert_absent_into(rows.select("sensor_id", "sensor_type"), path, "sensor_id")
    return spark.read.parquet(path)


@query
def gold_batches(spark, sf):
    """Gold from two bronze batches, the later one first and then once more, added up over the star."""
    fact, sensor, time = (Lake.of(spark, sf).gold_by_batch(t) for t in ("fact_readings", "dim_sensor", "dim_time"))
    return star.star(fact, sensor, time).groupBy("sensor_id", "sensor_type", "year", "month", "day", "hour", "level").agg(
        F.count("*").alias("readings"), F.min("value").alias("lo"), F.max("value").alias("hi"))


@query
def gold_batches_versions(spark, sf):
    """The facts by sensor version that grow with the same batches."""
    folder = Lake.of(spark, sf)
    return folder.gold_by_batch("fact_versions").select("version_key", "hour_key", "value", "level")


@query
def union_by_name(spark, sf):
    return scd.union_by_name(
        T.readings(spark, sf).select("sensor_id", "ts", "value", "raw_level"),
        T.shipments(spark, sf).select("value", "sensor_id", "event_date"))


@query
def table_profile(spark, sf):
    gold = Lake.of(spark, sf)
    gold.gold("fact_readings")
    return lake.profile_tables(spark, f"{gold.root}/gold")


@query
def level_csv(spark, sf):
    """A report written as CSV with header and read back."""
    folder = Lake.of(spark, sf)
    path = folder.scratch("report_csv")
    lake.write_csv(reports.count_by_level(folder.gold("fact_readings")), path)
    return spark.read.schema("level string, readings bigint").option("header", True).csv(path)


@query
def gold_views(spark, sf):
    """SQL text over the registered gold views."""
    folder = Lake.of(spark, sf)
    folder.gold("fact_readings")
    lake.register_views(spark, f"{folder.root}/gold")
    return spark.sql("""
        SELECT s.sensor_type, t.weekday, count(*) AS readings, max(f.value) AS max_value
        FROM fact_readings f JOIN dim_sensor s USING (sensor_key) JOIN dim_time t USING (hour_key)
        GROUP BY s.sensor_type, t.weekday""")


@query
def frame_in_sql(spark, sf):
    """SQL text over a frame passed by name."""
    return spark.sql(
        "SELECT sensor_type, level, count(*) AS readings FROM {r} GROUP BY sensor_type, level",
        r=level_of_readings(spark, sf))


@query
def clustered_fact_scan(spark, sf):
    """A one-year report on the fact rewritten in hour order with small row groups."""
    folder = Lake.of(spark, sf)
    target = folder.scratch("clustered")
    jobs.cluster_gold(spark, folder.long_gold_path(), target, row_group_bytes=1 << 20)
    return reports.monthly_summary(
        lake.read(spark, target, "fact_readings"), lake.read(spark, target, "dim_time"), 1997)


@query
def aligned_key_join(spark, sf):
    """A join on keys brought to the same type on both sides."""
    folder = Lake.of(spark, sf)
    wide = folder.gold("dim_sensor").withColumn("sensor_key", F.col("sensor_key").cast("bigint"))
    dim, fact = lake.align_key_types(wide, folder.gold("fact_readings"), {"sensor_key": "int", "sensor_id": "int"})
    return reports.avg_by_type(fact, dim)


# --- cleaning and quality ---------------------------------------------------------

@query
def silver_clean(spark, sf):
    return silver_of(spark, sf)


@query
def silver_clean_all_columns(spark, sf):
    """Copies must agree in the extraction columns too, so a re-extraction stays."""
    return cleaning.clean(T.bronze(spark, sf), include_metadata=True)


@query
def silver_clean_null_word(spark, sf):
    """Missing text becomes a word, as text conversion before folding makes it."""
    return cleaning.clean(T.bronze(spark, sf), null_text="None")


@query
def silver_sorted(spark, sf):
    """Silver as written in time order, with the place of each row in that order."""
    silver = Lake.of(spark, sf).silver().select("ts", "sensor_id", "reading_id", "value")
    return with_position(silver, ["ts", "sensor_id", "reading_id"], "place")


@query
def silver_batches(spark, sf):
    """Silver that took in one extraction after the other, the later one first."""
    return Lake.of(spark, sf).silver_by_batch()


@query
def quality_nulls(spark, sf):
    return quality.null_counts(T.bronze(spark, sf))


@query
def quality_describe(spark, sf):
    silver = Lake.of(spark, sf).silver()
    return quality.describe_all(silver.select("sensor_id", "event_date", "sensor_type", "value", "raw_level", "level"))


@query
def quality_describe_times(spark, sf):
    """Quartiles of the reading times, as seconds since 1970."""
    times = quality.describe_all(Lake.of(spark, sf).silver().select("ts"))
    return times.select("column", "count", *[F.round(c, 3).alias(c) for c in ("min", "q25", "q50", "q75", "max")])


@query
def quality_report(spark, sf):
    folder = Lake.of(spark, sf)
    return quality.quality_report(T.bronze(spark, sf), folder.silver())


# --- projections and scalar functions ---------------------------------------------------

@query
def time_attributes(spark, sf):
    holidays = spark.createDataFrame([("2024-01-01",), ("2024-01-06",)], "h string").select(
        F.to_date("h").alias("holiday"))
    return timeparts.with_calendar(T.readings(spark, sf).select("reading_id", "ts"), "ts", holidays)


@query
def scalar_functions(spark, sf):
    ts = F.col("ts")
    return T.readings(spark, sf).select(
        "reading_id",
        timeparts.hour_key(ts).alias("hour_key"),
        *[part.alias(name) for name, part in timeparts.date_parts(ts).items()],
        timeparts.weekday(ts).alias("weekday"),
        timeparts.stamp(ts).alias("stamp"),
        timeparts.utc(ts, "America/Lima").alias("as_utc"),
        timeparts.reading_uuid(F.col("sensor_id"), F.col("reading_id")).alias("uuid"),
        timeparts.gain(F.lit(100.0), F.col("value")).alias("gain"),
    )


@query
def classify_fixed(spark, sf):
    return level_of_readings(spark, sf).select("reading_id", "value", "level")


@query
def classify_by_type(spark, sf):
    return T.readings(spark, sf).select(
        "reading_id", "sensor_type", "value",
        levels.classify_by_type(F.col("sensor_type"), F.col("value")).alias("level"))


@query
def validate_range(spark, sf):
    return levels.validate_range(T.readings(spark, sf)).select("reading_id", "sensor_type", "value", "in_range")


@query
def validate_range_drop(spark, sf):
    return levels.validate_range(T.readings(spark, sf), mode="drop").select("reading_id", "sensor_type", "value")


@query
def threshold_deviation(spark, sf):
    return levels.threshold_deviation(T.readings(spark, sf)).select("reading_id", "value", "deviation")


@query
def threshold_deviation_by_type(spark, sf):
    return levels.threshold_deviation(T.readings(spark, sf), per_type=True).select(
        "reading_id", "sensor_type", "value", "deviation")


# --- star schema ---------------------------------------------------------------------

@query
def time_dim_hour(spark, sf):
    return star.build_time_dim(silver_of(spark, sf))


@query
def time_dim_reading(spark, sf):
    return star.build_time_dim(silver_of(spark, sf), "reading")


@query
def sensor_dim(spark, sf):
    return star.build_sensor_dim(silver_of(spark, sf))


@query
def fact_readings(spark, sf):
    folder = Lake.of(spark, sf)
    return star.build_fact(folder.silver(), folder.gold("dim_sensor"))


def _two_types(spark, sf):
    """Silver in which a sensor has several types."""
    silver = cleaning.with_level(T.as_readings(T.load(spark, sf, "events")).drop("sensor_type").withColumn(
        "sensor_type", F.concat(F.lit("kind-"), F.coalesce(F.trim("raw_level"), F.lit("none")))))
    return silver, star.build_sensor_dim(silver)


@query
def fact_two_types(spark, sf):
    return star.build_fact(*_two_types(spark, sf)).groupBy("sensor_key", "level").agg(F.count("*").alias("readings"))


@query
def fact_two_types_by_id(spark, sf):
    """Joined on the sensor alone, every reading meets each type of its sensor."""
    fact = star.build_fact(*_two_types(spark, sf), on=("sensor_id",))
    return fact.groupBy("sensor_key", "level").agg(F.count("*").alias("readings"))


@query
def star_join(spark, sf):
    g = Lake.of(spark, sf).gold
    return star.star(g("fact_readings"), g("dim_sensor"), g("dim_time"))


@query
def alert_dim(spark, sf):
    """Readings per alert action, through the alert dimension."""
    dim = build_alert_dim(spark)
    typed = T.readings(spark, sf).withColumn(
        "level", levels.classify_by_type(F.col("sensor_type"), F.col("value")))
    return typed.groupBy("sensor_type", "level").agg(F.count("*").alias("readings")).join(
        dim, ["sensor_type", "level"])


@query
def turbine_dim(spark, sf):
    rows = T.load(spark, sf, "supplier").join(
        T.load(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_nationkey").alias("turbine_id"), F.col("n_name").alias("name"),
        (F.col("n_regionkey") * 100).alias("capacity"), F.lit("active").alias("state"))
    return build_turbine_dim(rows)


# --- queries on gold and on raw readings -------------------------------------------------

def _on_gold(name, fn, *needs, time="dim_time", **options):
    def run(spark, sf):
        folder = Lake.of(spark, sf)
        frames = [folder.dim_time_reading() if n == "dim_time" and time == "reading" else folder.gold(n)
                  for n in needs]
        return fn(*frames, **options)

    run.__name__ = name
    query(run)


_STAR = ("fact_readings", "dim_sensor", "dim_time")
_on_gold("avg_by_sensor", reports.avg_by_sensor, "fact_readings", "dim_sensor")
_on_gold("readings_per_hour", reports.readings_per_hour, "fact_readings", "dim_time")
_on_gold("readings_per_hour_fanout", reports.readings_per_hour, "fact_readings", "dim_time", time="reading")
_on_gold("count_by_level", reports.count_by_level, "fact_readings")
_on_gold("avg_by_type", reports.avg_by_type, "fact_readings", "dim_sensor")
_on_gold("critical_events", reports.critical_events, *_STAR)
_on_gold("critical_events_fanout", reports.critical_events_by_reading_time, *_STAR, time="reading")
_FACT_TIME = ("fact_readings", "dim_time")
for _name, _needs in {"dash_by_type": _STAR, "dash_by_level": _FACT_TIME, "level_share": _FACT_TIME,
                      "dash_avg_by_sensor": _STAR, "dash_trend": _FACT_TIME}.items():
    _on_gold(_name, getattr(reports, _name), *_needs)
    _on_gold(f"{_name}_fanout", getattr(reports, _name), *_needs, time="reading")


def _on_long_gold(name, fn, *needs, **options):
    def run(spark, sf):
        return fn(*[Lake.of(spark, sf).long_gold(n) for n in needs], **options)

    run.__name__ = name
    query(run)


_on_long_gold("monthly_summary", reports.monthly_summary, "fact_readings", "dim_time", year=1997)
_on_long_gold("alerts_by_type", reports.alerts_by_type, "fact_readings", "dim_sensor")
_on_long_gold("daily_summary", reports.daily_summary, *_STAR, year=1997, month=6)


@query
def avg_by_sensor_raw(spark, sf):
    return reports.avg_by_sensor_raw(T.readings(spark, sf))


@query
def avg_by_sensor_dirty(spark, sf):
    """The raw query on bronze: missing sensors form no group, missing values are skipped."""
    return reports.avg_by_sensor_raw(T.bronze(spark, sf))


@query
def readings_by_hour_of_day(spark, sf):
    return reports.readings_by_hour_of_day(T.readings(spark, sf))


@query
def count_by_raw_level(spark, sf):
    return reports.count_by_raw_level(T.readings(spark, sf))


@query
def avg_by_type_raw(spark, sf):
    return reports.avg_by_type_raw(T.readings(spark, sf))


@query
def critical_events_raw(spark, sf):
    return reports.critical_events_raw(cleaning.normalize_text(T.readings(spark, sf)))


# --- sensor lifecycle and changing dimensions ---------------------------------------------

@query
def sensor_validity(spark, sf):
    """Readings with the life of their own sensor, and whether it was in service."""
    life = T.lifecycle(spark, sf).select("sensor_id", "valid_from", "valid_to")
    valid = scd.valid_at(F.col("ts"), F.col("valid_from"), F.col("valid_to"))
    return T.readings(spark, sf).join(life, "sensor_id").select(
        "reading_id", "sensor_id", "ts", "valid_from", "valid_to", valid.alias("in_service"))


@query
def active_sensors(spark, sf):
    rows = T.readings(spark, sf).select("reading_id", "sensor_type", "ts")
    return lifecycle.active_sensors(rows, Lake.of(spark, sf).service_slices())


@query
def service_counts(spark, sf):
    return lifecycle.service_counts(T.lifecycle(spark, sf))


@query
def assign_sensor(spark, sf):
    rows = T.readings(spark, sf).select("reading_id", "sensor_type", "ts")
    return lifecycle.assign_sensor(rows, Lake.of(spark, sf).calendar())


@query
def assign_sensor_even(spark, sf):
    """Each reading gets one of the sensors in service, by its own number."""
    rows = T.readings(spark, sf).select("reading_id", "sensor_type", "ts")
    pick = F.col("reading_id").cast("bigint") * 7919
    return lifecycle.assign_evenly(rows, Lake.of(spark, sf).service_index(), pick)


@query
def assign_sensor_shares(spark, sf):
    """Readings that each sensor got, next to what an even share among those in service would be."""
    even = assign_sensor_even(spark, sf).where("assigned_id IS NOT NULL")
    return even.groupBy("sensor_type", "n_active", "assigned_id").agg(F.count("*").alias("readings"))


@query
def replacement_of(spark, sf):
    return lifecycle.replacement_of(T.lifecycle(spark, sf))


@query
def last_successor(spark, sf):
    return lifecycle.last_successor(T.replacements(spark, sf))


@query
def scd1_upsert(spark, sf):
    dim = T.load(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer"), F.col("c_mktsegment").alias("priority"))
    dim = dim.withColumns({"effective": F.lit(None).cast("timestamp"), "change_id": F.lit(None).cast("bigint")})
    return scd.scd1_upsert(dim, T.priorities(spark, sf), "customer", ["effective", "change_id"])


@query
def scd2_build(spark, sf):
    return scd.scd2_build(T.priorities(spark, sf), "customer", ["priority"], "effective", "change_id")


@query
def scd2_merge(spark, sf):
    """Two thirds of all orders, then the last third in two merges: mostly late, many equal to the state before."""
    folder = Lake.of(spark, sf)
    return scd.versions_of(folder.merged_points(), "customer", ["priority"], "effective").drop("version_key")


@query
def scd2_merge_keys(spark, sf):
    """Numbers after the merges: no two versions share one, and none has gone from one customer to another."""
    folder = Lake.of(spark, sf)
    before = scd.versions_of(folder.first_points(), "customer", ["priority"], "effective")
    after = scd.versions_of(folder.merged_points(), "customer", ["priority"], "effective")
    old = before.select("version_key", F.col("customer").alias("owner"))
    return after.join(old, "version_key", "left").agg(
        F.count("*").alias("versions"), F.count_distinct("version_key").alias("numbers"),
        F.count_if(F.col("owner") != F.col("customer")).alias("moved"))


def _orders(spark, sf):
    return T.load(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("customer"), F.col("o_orderdate").cast("timestamp").alias("ordered"))


@query
def join_as_of(spark, sf):
    return scd.join_as_of(_orders(spark, sf), Lake.of(spark, sf).version_slices(), "customer", "ordered")


@query
def join_as_of_carried(spark, sf):
    """The same join along one order of facts and versions."""
    return asof.carry_forward(_orders(spark, sf), Lake.of(spark, sf).versions(), "customer", "ordered", "inner")


@query
def join_as_of_cells(spark, sf):
    """The same join through time cells, for keys with very many versions."""
    return scd.join_as_of(_orders(spark, sf), Lake.of(spark, sf).versions(), "customer", "ordered", cell="month")


@query
def join_as_of_few(spark, sf):
    """The same join where keys have a handful of versions."""
    return scd.join_as_of(_orders(spark, sf), Lake.of(spark, sf).versions(), "customer", "ordered", few=True)


@query
def fact_versions(spark, sf):
    """Readings under the version of their sensor that was valid at their time."""
    folder = Lake.of(spark, sf)
    return star.build_versioned_fact(folder.silver(), folder.sensor_versions())


# --- alerts, episodes and roll-ups -----------------------------------------------------------

@query
def alert_counts(spark, sf):
    return rollups.alert_counts(level_of_readings(spark, sf))


@query
def alert_frequency(spark, sf):
    return rollups.alert_frequency(level_of_readings(spark, sf))


@query
def alert_frequency_turbine(spark, sf):
    shipped = cleaning.with_level(T.shipments(spark, sf))
    return rollups.alert_frequency(shipped, "month", "turbine_id", T.turbines(spark, sf))


@query
def anomaly_episodes(spark, sf):
    """Episodes along time cells."""
    return episodes.anomaly_episodes(level_of_readings(spark, sf), cell="hour")


@query
def anomaly_episodes_positions(spark, sf):
    """The same episodes from positions in the global order."""
    return episodes.anomaly_episodes(level_of_readings(spark, sf))


@query
def anomaly_episodes_long(spark, sf):
    """Episodes over seven years, cut into months; many readings share a time."""
    return episodes.anomaly_episodes(Lake.of(spark, sf).long_silver(), cell="month")


@query
def semi_additive(spark, sf):
    return rollups.semi_additive(T.readings(spark, sf), ["sensor_type", "event_date"])


@query
def rollup_hour(spark, sf):
    return rollups.rollup_readings(level_of_readings(spark, sf), "hour", "sensor_type")


@query
def rollup_day(spark, sf):
    return rollups.rollup_readings(level_of_readings(spark, sf), "day", "sensor_id")


@query
def rollup_cells_day(spark, sf):
    """The same per day from the hourly sums that grow with batches of gold."""
    return rollups.rollup_cells(Lake.of(spark, sf).gold_by_batch("hourly_cells"), "day", "sensor_id")


@query
def rollup_turbine(spark, sf):
    shipped = cleaning.with_level(T.shipments(spark, sf))
    return rollups.rollup_readings(shipped, "day", "turbine_id", T.turbines(spark, sf))


# --- streaming ---------------------------------------------------------------------------------

def _drained(spark, sf, stream):
    """Run the stream over all input and return what it wrote."""
    root = Lake.of(spark, sf).scratch("stream")
    streams.run_available(stream, f"{root}/out", f"{root}/state")
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def _whole(spark, sf, stream):
    """Run the stream over all input and return the whole result after its last trigger."""
    root = Lake.of(spark, sf).scratch("stream")
    return streams.run_whole(stream, f"{root}/out", f"{root}/state")


@query
def stream_alerts(spark, sf):
    dirty = T.as_dirty_bronze(T.event_stream(spark, sf))
    return _drained(spark, sf, streams.stream_alerts(dirty).select("reading_id", "sensor_id", "ts", "value", "level"))


@query
def stream_alerts_by_type(spark, sf):
    dirty = T.as_dirty_bronze(T.event_stream(spark, sf))
    alerts = streams.stream_alerts(dirty, levels.BANDS)
    return _drained(spark, sf, alerts.select("reading_id", "sensor_type", "ts", "value", "level"))


@query
def stream_dedupe(spark, sf):
    clean = streams.stream_clean(T.as_dirty_bronze(T.event_stream(spark, sf)))
    rows = clean.select("reading_id", "sensor_id", "ts", "sensor_type", "value", "level")
    return _drained(spark, sf, streams.stream_dedupe(rows))


@query
def stream_hourly(spark, sf):
    return _whole(spark, sf, streams.stream_hourly(T.as_readings(T.event_stream(spark, sf)), delay=None))


@query
def stream_sessions(spark, sf):
    rows = cleaning.with_level(T.as_readings(T.event_stream(spark, sf)))
    return _whole(spark, sf, streams.stream_sessions(rows, gap="12 hours", delay=None))


def _by_increments(spark, sf, rows, partial, total):
    """Events in files out of order, two a trigger; the increments are put together before the last files arrive."""
    root = Lake.of(spark, sf).scratch("stream")
    events = T.load(spark, sf, "events")
    schema = partial(rows(events)).schema
    for late in (0, 1):
        part = events.where((F.col("event_id") % 5 == 0) == bool(late))
        part.repartition(3, "event_id").write.mode("append").parquet(f"{root}/in")
        source = streams.stream_readings(spark, f"{root}/in", "parquet", T.SCHEMAS["events"], files_per_trigger=2)
        increments.run_increments(rows(source), partial, f"{root}/out", f"{root}/state")
        if not late:
            increments.compact(spark, f"{root}/out", total, schema)
    return increments.read_whole(spark, f"{root}/out", total, schema)


@query
def stream_hourly_increments(spark, sf):
    return _by_increments(spark, sf, T.as_readings, increments.hourly, increments.hourly_total)


@query
def stream_sessions_increments(spark, sf):
    rows = lambda events: cleaning.with_level(T.as_readings(events))
    whole = _by_increments(spark, sf, rows, *increments.sessions("12 hours"))
    seconds = (F.unix_micros("end_ts") - F.unix_micros("start_ts")) / F.lit(1e6)
    return whole.withColumn("duration_s", seconds)
