"""The same results in SQL, straight from the driver's tables.

Written independently of the Spark code: plain joins and windows, no
pre-aggregation, no time cells. Averages are compared to six places. An average
of two-decimal values often ends exactly half way between two of them, where
the order of summation would decide; both sides therefore add 1e-9 first.
"""

from __future__ import annotations

_TYPE = """CASE {0} % 4 WHEN 0 THEN 'temperatura' WHEN 1 THEN 'presion'
    WHEN 2 THEN 'vibracion' ELSE 'nivel_agua' END"""
_LEVEL = "CASE WHEN value > 80 THEN 'CRITICA' WHEN value > 60 THEN 'ADVERTENCIA' ELSE 'NORMAL' END"
_STRIP = "trim({0}, ' ' || chr(9) || chr(10) || chr(13))"
_HOUR_KEY = "CAST(strftime({0}, '%Y%m%d%H') AS BIGINT)"

_READINGS = f"""readings AS (
  SELECT CAST(user_id AS INTEGER) AS sensor_id, CAST(ts AS DATE) AS event_date, ts,
    CAST(event_id AS VARCHAR) AS reading_id, {_TYPE.format('user_id')} AS sensor_type, value,
    CASE event_type WHEN 'error' THEN ' critica ' WHEN 'purchase' THEN 'Advertencia'
      WHEN 'signup' THEN NULL ELSE 'normal' END AS raw_level
  FROM events)"""

_BRONZE = _READINGS + """,
once AS (
  SELECT CASE WHEN reading_id::BIGINT % 101 = 0 THEN NULL ELSE sensor_id END AS sensor_id, event_date,
    CASE WHEN reading_id::BIGINT % 103 = 0 THEN 'not-a-date' ELSE CAST(ts AS VARCHAR) END AS ts, reading_id,
    CASE WHEN reading_id::BIGINT % 7 = 0 THEN chr(9) || upper(sensor_type) || ' ' || chr(10)
      ELSE sensor_type END AS sensor_type,
    CASE WHEN reading_id::BIGINT % 97 = 0 THEN -value WHEN reading_id::BIGINT % 89 = 0 THEN NULL
      ELSE value END AS value,
    raw_level, 'doc-' || reading_id AS _id
  FROM readings),
bronze AS (
  SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS _extracted_at, 'landing' AS _source FROM once
  UNION ALL
  SELECT *, TIMESTAMP '2024-02-02 00:00:00', 'landing' FROM once WHERE reading_id::BIGINT % 50 = 0)"""

_CLEAN = f"""cleaned AS (
  SELECT sensor_id, event_date, TRY_CAST(ts AS TIMESTAMP) AS ts, reading_id,
    {_STRIP.format('lower({type})')} AS sensor_type, value, {_STRIP.format('upper({raw})')} AS raw_level,
    _extracted_at, _source
  FROM bronze
  WHERE sensor_id IS NOT NULL AND TRY_CAST(ts AS TIMESTAMP) IS NOT NULL AND value IS NOT NULL AND value >= 0)"""
_SILVER = _BRONZE + ",\n" + _CLEAN.format(type="sensor_type", raw="raw_level") + f""",
silver AS (
  SELECT sensor_id, event_date, ts, reading_id, sensor_type, value, raw_level,
    min(_extracted_at) AS _extracted_at, arg_min(_source, _extracted_at) AS _source, {_LEVEL} AS level
  FROM cleaned GROUP BY ALL)"""

_STAR = f"""
dim_sensor AS (
  SELECT sensor_id, sensor_type,
    CAST(row_number() OVER (ORDER BY sensor_id, sensor_type NULLS FIRST) AS INTEGER) AS sensor_key
  FROM (SELECT DISTINCT sensor_id, sensor_type FROM silver)),
hours AS (SELECT DISTINCT date_trunc('hour', ts) AS ts FROM silver),
times AS (SELECT DISTINCT ts FROM silver),
dim_time AS (SELECT {_HOUR_KEY.format('ts')} AS hour_key, ts, year(ts) AS year, month(ts) AS month, day(ts) AS day,
  hour(ts) AS hour, strftime(ts, '%w') AS weekday, CAST(ts AS DATE) AS date, minute(ts) AS minute,
  dayofweek(ts) IN (0, 6) AS is_weekend, false AS is_holiday FROM hours),
dim_time_reading AS (SELECT {_HOUR_KEY.format('ts')} AS hour_key, ts, year(ts) AS year, month(ts) AS month,
  day(ts) AS day, hour(ts) AS hour, strftime(ts, '%w') AS weekday, CAST(ts AS DATE) AS date, minute(ts) AS minute,
  dayofweek(ts) IN (0, 6) AS is_weekend, false AS is_holiday FROM times),
fact AS (
  SELECT sensor_key, {_HOUR_KEY.format('ts')} AS hour_key, value, level
  FROM silver JOIN dim_sensor ON silver.sensor_id = dim_sensor.sensor_id
    AND silver.sensor_type IS NOT DISTINCT FROM dim_sensor.sensor_type)"""
_GOLD = _SILVER + "," + _STAR

_SHIPMENTS = f"""shipped AS (
  SELECT CAST(l_suppkey AS INTEGER) AS sensor_id, CAST(l_shipdate AS DATE) AS event_date, l_shipdate AS ts,
    l_orderkey || '-' || l_linenumber AS reading_id, {_TYPE.format('l_suppkey')} AS sensor_type,
    l_quantity * 2 AS value
  FROM lineitem)"""
_LONG_SILVER = _SHIPMENTS + f",\nsilver AS (SELECT DISTINCT *, {_LEVEL} AS level FROM shipped)"
_LONG_GOLD = _LONG_SILVER + "," + _STAR

_LIFE = f"""life AS (
  SELECT CAST(s_suppkey AS INTEGER) AS sensor_id, {_TYPE.format('s_suppkey')} AS sensor_type,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(s_suppkey AS INTEGER)) AS valid_from,
    CASE WHEN s_suppkey % 2 = 0 THEN TIMESTAMP '2024-01-15 06:00:00' END AS valid_to,
    CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey + 1 AS INTEGER) END AS replacement_id
  FROM supplier)"""
_TURBINES = "turbines AS (SELECT CAST(s_suppkey AS INTEGER) AS sensor_id, s_nationkey AS turbine_id FROM supplier)"
_LEVELED = _READINGS + f",\nleveled AS (SELECT *, {_LEVEL} AS level FROM readings)"

_BANDS = """bands(sensor_type, level, lo, hi) AS (VALUES
  ('temperatura', 'NORMAL', 50, 75), ('temperatura', 'ADVERTENCIA', 76, 89), ('temperatura', 'CRITICA', 90, 100),
  ('presion', 'NORMAL', 20, 40), ('presion', 'ADVERTENCIA', 41, 59), ('presion', 'CRITICA', 60, 80),
  ('vibracion', 'NORMAL', 1, 5), ('vibracion', 'ADVERTENCIA', 6, 9), ('vibracion', 'CRITICA', 10, 15),
  ('nivel_agua', 'NORMAL', 10, 18), ('nivel_agua', 'ADVERTENCIA', 19, 24), ('nivel_agua', 'CRITICA', 25, 35))"""
_RANGES = """ranges(sensor_type, lo, hi) AS (VALUES
  ('temperatura', 50, 100), ('presion', 20, 80), ('vibracion', 1, 15), ('nivel_agua', 10, 35))"""


# the sensor number reading_id * 7919 modulo their count, of the members of all dyadic nodes above the reading's segment
_EVEN = """,
served AS (SELECT * FROM life WHERE valid_to IS NULL OR valid_to > valid_from),
instants AS (
  SELECT sensor_type, moment, row_number() OVER (ORDER BY sensor_type, moment) AS p
  FROM (SELECT sensor_type, valid_from AS moment FROM served UNION
    SELECT sensor_type, valid_to FROM served WHERE valid_to IS NOT NULL)),
spans AS (
  SELECT sensor_id, i.p AS a, coalesce(j.p, (SELECT max(p) + 1 FROM instants e WHERE e.sensor_type = s.sensor_type)) AS b
  FROM served s JOIN instants i ON i.sensor_type = s.sensor_type AND i.moment = s.valid_from
    LEFT JOIN instants j ON j.sensor_type = s.sensor_type AND j.moment = s.valid_to),
steps AS (
  SELECT sensor_id, l, (a + (CAST(1 AS BIGINT) << l) - 1) >> l AS lo, b >> l AS hi
  FROM spans CROSS JOIN (SELECT unnest(range(40)) AS l)),
members AS (
  SELECT l, j, sensor_id, row_number() OVER (PARTITION BY l, j ORDER BY sensor_id) - 1 AS k
  FROM (SELECT sensor_id, l, lo AS j FROM steps WHERE lo < hi AND lo % 2 = 1 UNION ALL
    SELECT sensor_id, l, hi - 1 FROM steps WHERE lo < hi AND hi % 2 = 1)),
above AS (
  SELECT p, l, j, n, sum(n) OVER (PARTITION BY p ORDER BY l) - n AS before,
    CAST(sum(n) OVER (PARTITION BY p) AS BIGINT) AS n_active
  FROM instants JOIN (SELECT l, j, count(*) AS n FROM members GROUP BY ALL) ON p >> l = j),
placed AS (
  SELECT reading_id, r.sensor_type, ts, p FROM readings r ASOF LEFT JOIN instants i
    ON r.sensor_type = i.sensor_type AND r.ts >= i.moment),
assigned AS (
  SELECT reading_id, sensor_type, ts, coalesce(n_active, 0) AS n_active, sensor_id AS assigned_id
  FROM placed r LEFT JOIN above ON above.p = r.p
      AND CAST(reading_id AS BIGINT) * 7919 % n_active >= before AND CAST(reading_id AS BIGINT) * 7919 % n_active < before + n
    LEFT JOIN members m ON m.l = above.l AND m.j = above.j AND m.k = CAST(reading_id AS BIGINT) * 7919 % n_active - before)"""


def _versions(where: str, prefix: str = "") -> str:
    """Version ranges of each customer's order priority."""
    p = prefix
    return f"""{p}last AS (
  SELECT o_custkey AS customer, o_orderdate AS effective, arg_max(o_orderpriority, o_orderkey) AS priority
  FROM orders WHERE {where} GROUP BY ALL),
{p}marked AS (
  SELECT *, lag(priority) OVER (PARTITION BY customer ORDER BY effective) AS previous FROM {p}last),
{p}ranges AS (
  SELECT customer, priority, effective AS valid_from,
    lead(effective) OVER (PARTITION BY customer ORDER BY effective) AS valid_to
  FROM {p}marked WHERE priority IS DISTINCT FROM previous),
{p}versions AS (
  SELECT customer, priority, valid_from, valid_to, valid_to IS NULL AS is_active,
    row_number() OVER (ORDER BY customer, valid_from) AS version_key
  FROM {p}ranges)"""


def _episodes(source: str) -> str:
    return f"""marked AS (
  SELECT *, level <> 'NORMAL' AS alert,
    sum(CASE WHEN level = 'NORMAL' THEN 1 ELSE 0 END)
      OVER (PARTITION BY sensor_id ORDER BY ts, reading_id ROWS UNBOUNDED PRECEDING) AS run
  FROM {source})
SELECT sensor_id, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS readings, max(value) AS max_value,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_s
FROM marked WHERE alert GROUP BY sensor_id, run"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


_JOIN_SENSOR = "fact JOIN dim_sensor USING (sensor_key)"
_JOIN_BOTH = "fact JOIN dim_sensor USING (sensor_key) JOIN {0} USING (hour_key)"

ORACLE: dict[str, str] = {
    # --- sources and sinks
    "bronze_ingest": _with(_READINGS, """
        SELECT sensor_id, event_date, strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0
            THEN '' ELSE '.' || rtrim(strftime(ts, '%f'), '0') END AS ts, reading_id, sensor_type,
          value, raw_level, 'json_landing' AS _source, 'doc-' || reading_id AS _id, '20240201_0000' AS ingest_batch
        FROM readings
        UNION ALL
        SELECT sensor_id, event_date, strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0
            THEN '' ELSE '.' || rtrim(strftime(ts, '%f'), '0') END, reading_id, sensor_type, value, NULL,
          'parquet_landing', NULL, '20240202_0000'
        FROM readings"""),
    "bronze_merged_schema": _with(_READINGS, """
        SELECT 'a' AS _source, count(*) AS readings, count(raw_level) AS levels, count(*) AS stamped FROM readings
        UNION ALL SELECT 'b', count(*), 0, count(*) FROM readings"""),
    "append_readings": _with(_READINGS + ",\n" + _SHIPMENTS, """
        SELECT sensor_type, event_date, count(*) AS readings, max(value) AS max_value FROM (
          SELECT sensor_type, event_date, value FROM readings
          UNION ALL SELECT sensor_type, event_date, value FROM shipped) GROUP BY ALL"""),
    "insert_absent": _with(_READINGS + ",\n" + _SHIPMENTS, """
        SELECT DISTINCT sensor_id, sensor_type FROM (
          SELECT sensor_id, sensor_type FROM readings UNION ALL SELECT sensor_id, sensor_type FROM shipped)
        WHERE sensor_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)"""),
    "insert_absent_into": _with(_READINGS + ",\n" + _SHIPMENTS + ",\n" + _LIFE, """
        SELECT sensor_id, sensor_type FROM life WHERE sensor_id % 2 = 0 UNION ALL
        SELECT DISTINCT sensor_id, sensor_type FROM (
          SELECT sensor_id, sensor_type FROM readings UNION ALL SELECT sensor_id, sensor_type FROM shipped)
        WHERE sensor_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)"""),
    "gold_batches": _with(_GOLD, f"""
        SELECT sensor_id, sensor_type, year, month, day, hour, level, count(*) AS readings, min(value) AS lo, max(value) AS hi
        FROM {_JOIN_BOTH.format("dim_time")} GROUP BY ALL"""),
    "union_by_name": _with(_READINGS + ",\n" + _SHIPMENTS, """
        SELECT sensor_id, ts, value, raw_level, CAST(NULL AS DATE) AS event_date FROM readings
        UNION ALL SELECT sensor_id, NULL, value, NULL, event_date FROM shipped"""),
    "table_profile": _with(_GOLD, """
        SELECT t AS "table", CASE t WHEN 'dim_time' THEN (SELECT count(*) FROM dim_time)
            WHEN 'dim_sensor' THEN (SELECT count(*) FROM dim_sensor) ELSE (SELECT count(*) FROM fact) END AS rows,
          CAST(position AS INTEGER) AS position, c AS "column", type
        FROM (VALUES ('dim_time', 1, 'hour_key', 'bigint'), ('dim_time', 2, 'ts', 'timestamp'),
          ('dim_time', 3, 'year', 'bigint'), ('dim_time', 4, 'month', 'bigint'), ('dim_time', 5, 'day', 'bigint'),
          ('dim_time', 6, 'hour', 'bigint'), ('dim_time', 7, 'weekday', 'string'), ('dim_time', 8, 'date', 'date'),
          ('dim_time', 9, 'minute', 'bigint'), ('dim_time', 10, 'is_weekend', 'boolean'), ('dim_time', 11, 'is_holiday', 'boolean'),
          ('dim_sensor', 1, 'sensor_id', 'int'), ('dim_sensor', 2, 'sensor_type', 'string'),
          ('dim_sensor', 3, 'sensor_key', 'int'), ('fact_readings', 1, 'sensor_key', 'int'),
          ('fact_readings', 2, 'hour_key', 'bigint'), ('fact_readings', 3, 'value', 'double'),
          ('fact_readings', 4, 'level', 'string')) AS v(t, position, c, type)"""),
    "level_csv": _with(_SILVER, "SELECT level, count(*) AS readings FROM silver GROUP BY level"),
    "gold_views": _with(_SILVER, """
        SELECT sensor_type, strftime(ts, '%w') AS weekday, count(*) AS readings, max(value) AS max_value
        FROM silver GROUP BY ALL"""),
    "frame_in_sql": _with(_LEVELED, """
        SELECT sensor_type, level, count(*) AS readings FROM leveled GROUP BY ALL"""),
    "clustered_fact_scan": _with(_LONG_GOLD, """
        SELECT year, month, round(avg(value) + 1e-9, 6) AS avg_value, count(*) AS readings
        FROM fact JOIN dim_time USING (hour_key) WHERE year = 1997 GROUP BY year, month"""),
    "aligned_key_join": _with(_GOLD, f"""
        SELECT sensor_type, round(avg(value) + 1e-9, 6) AS avg_value FROM {_JOIN_SENSOR} GROUP BY sensor_type"""),
    # --- cleaning and quality
    "silver_clean": _with(_SILVER, "SELECT * FROM silver"),
    "silver_batches": _with(_SILVER, "SELECT * FROM silver"),
    "silver_clean_all_columns": _with(_BRONZE + ",\n" + _CLEAN.format(type="sensor_type", raw="raw_level"), f"""
        SELECT DISTINCT *, {_LEVEL} AS level FROM cleaned"""),
    "silver_clean_null_word": _with(_BRONZE + ",\n" + _CLEAN.format(
        type="coalesce(sensor_type, 'None')", raw="coalesce(raw_level, 'None')"), f"""
        SELECT sensor_id, event_date, ts, reading_id, sensor_type, value, raw_level,
          min(_extracted_at) AS _extracted_at, arg_min(_source, _extracted_at) AS _source, {_LEVEL} AS level
        FROM cleaned GROUP BY ALL"""),
    "silver_sorted": _with(_SILVER, """
        SELECT ts, sensor_id, reading_id, value,
          row_number() OVER (ORDER BY ts, sensor_id, reading_id) AS place FROM silver"""),
    "quality_nulls": _with(_BRONZE, "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM bronze""" for c in (
            "sensor_id", "event_date", "ts", "reading_id", "sensor_type", "value", "raw_level", "_id",
            "_extracted_at", "_source"))),
    "quality_report": _with(_SILVER, "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls, count(*) AS bronze_rows,
        (SELECT count(*) FROM silver) AS silver_rows FROM bronze""" for c in (
            "sensor_id", "event_date", "ts", "reading_id", "sensor_type", "value", "raw_level", "_id",
            "_extracted_at", "_source"))),
    "quality_describe": _with(_SILVER, "\nUNION ALL ".join(
        [f"""SELECT '{c}' AS "column", count({c}) AS count, CAST(NULL AS BIGINT) AS unique, NULL AS top,
          CAST(NULL AS BIGINT) AS freq, round(avg({c}) + 1e-9, 6) AS mean, round(stddev_samp({c}) + 1e-9, 6) AS std,
          CAST(min({c}) AS DOUBLE) AS min, CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS q25,
          CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS q50, CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS q75,
          CAST(max({c}) AS DOUBLE) AS max FROM silver""" for c in ("sensor_id", "value")]
        + [f"""SELECT '{c}', count({c}), count(DISTINCT {c}),
          (SELECT CAST({c} AS VARCHAR) FROM silver WHERE {c} IS NOT NULL GROUP BY {c}
           ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1),
          (SELECT count(*) FROM silver WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1),
          NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM silver"""
           for c in ("event_date", "sensor_type", "raw_level", "level")])),
    "quality_describe_times": _with(_SILVER, """
        SELECT 'ts' AS "column", count(*) AS count, round(min(epoch(ts)), 3) AS min,
          round(quantile_cont(epoch(ts), 0.25), 3) AS q25, round(quantile_cont(epoch(ts), 0.5), 3) AS q50,
          round(quantile_cont(epoch(ts), 0.75), 3) AS q75, round(max(epoch(ts)), 3) AS max FROM silver"""),
    # --- projections and scalar functions
    "time_attributes": _with(_READINGS, """
        SELECT reading_id, ts, CAST(ts AS DATE) AS date, minute(ts) AS minute, dayofweek(ts) IN (0, 6) AS is_weekend,
          CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-01-06') AS is_holiday FROM readings"""),
    "scalar_functions": _with(_READINGS, f"""
        SELECT reading_id, {_HOUR_KEY.format('ts')} AS hour_key, year(ts) AS year, month(ts) AS month, day(ts) AS day,
          hour(ts) AS hour, strftime(ts, '%w') AS weekday, strftime(ts, '%Y%m%d_%H%M') AS stamp,
          ts + INTERVAL 5 HOUR AS as_utc, sha256(sensor_id || chr(31) || reading_id) AS uuid,
          round(100.0::DOUBLE / nullif(value, 0) + 1e-9, 6) AS gain FROM readings"""),
    "classify_fixed": _with(_LEVELED, "SELECT reading_id, value, level FROM leveled"),
    "classify_by_type": _with(_READINGS + ",\n" + _BANDS, """
        SELECT reading_id, r.sensor_type, value, level
        FROM readings r LEFT JOIN bands b ON r.sensor_type = b.sensor_type AND value BETWEEN lo AND hi"""),
    "validate_range": _with(_READINGS + ",\n" + _RANGES, """
        SELECT reading_id, sensor_type, value, value BETWEEN lo AND hi AS in_range
        FROM readings JOIN ranges USING (sensor_type)"""),
    "validate_range_drop": _with(_READINGS + ",\n" + _RANGES, """
        SELECT reading_id, sensor_type, value FROM readings JOIN ranges USING (sensor_type)
        WHERE value BETWEEN lo AND hi"""),
    "threshold_deviation": _with(_READINGS, """
        SELECT reading_id, value, round(value - 80 + 1e-9, 6) AS deviation FROM readings"""),
    "threshold_deviation_by_type": _with(_READINGS + ",\n" + _BANDS, """
        SELECT reading_id, sensor_type, value, round(value - hi + 1e-9, 6) AS deviation
        FROM readings JOIN bands USING (sensor_type) WHERE level = 'NORMAL'"""),
    # --- star schema
    "time_dim_hour": _with(_GOLD, "SELECT * FROM dim_time"),
    "time_dim_reading": _with(_GOLD, "SELECT * FROM dim_time_reading"),
    "sensor_dim": _with(_GOLD, "SELECT * FROM dim_sensor"),
    "fact_readings": _with(_GOLD, "SELECT * FROM fact"),
    "star_join": _with(_GOLD, "SELECT * FROM " + _JOIN_BOTH.format("dim_time")),
    "alert_dim": _with(_READINGS + ",\n" + _BANDS, """
        SELECT sensor_type, level, count(*) AS readings, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi,
          lo || '-' || hi AS threshold,
          CASE level WHEN 'NORMAL' THEN 'none' WHEN 'ADVERTENCIA' THEN 'watch' ELSE 'inspect' END AS action
        FROM readings JOIN bands USING (sensor_type) WHERE value BETWEEN lo AND hi GROUP BY ALL"""),
    "turbine_dim": """
        SELECT turbine_id, name, capacity, state, CAST(row_number() OVER (ORDER BY turbine_id) AS INTEGER) AS turbine_key
        FROM (SELECT DISTINCT n_nationkey AS turbine_id, n_name AS name, n_regionkey * 100 AS capacity,
          'active' AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey)""",
    # --- queries on gold
    "avg_by_sensor": _with(_GOLD, f"""
        SELECT sensor_id, round(avg(value) + 1e-9, 6) AS avg_value FROM {_JOIN_SENSOR} GROUP BY sensor_id"""),
    "count_by_level": _with(_GOLD, "SELECT level, count(*) AS readings FROM fact GROUP BY level"),
    "avg_by_type": _with(_GOLD, f"""
        SELECT sensor_type, round(avg(value) + 1e-9, 6) AS avg_value FROM {_JOIN_SENSOR} GROUP BY sensor_type"""),
    "critical_events": _with(_GOLD, f"""
        SELECT sensor_id, ts, value, level FROM {_JOIN_BOTH.format('dim_time')} WHERE level = 'CRITICA'"""),
    "critical_events_fanout": _with(_GOLD, """,
        numbered AS (SELECT *, row_number() OVER () AS fact_id FROM fact WHERE level = 'CRITICA')
        SELECT sensor_id, value, level, count(*) AS n_times, min(ts) AS first_ts, max(ts) AS last_ts
        FROM numbered JOIN dim_sensor USING (sensor_key) JOIN dim_time_reading USING (hour_key)
        GROUP BY fact_id, sensor_id, value, level"""),
    "monthly_summary": _with(_LONG_GOLD, """
        SELECT year, month, round(avg(value) + 1e-9, 6) AS avg_value, count(*) AS readings
        FROM fact JOIN dim_time USING (hour_key) WHERE year = 1997 GROUP BY year, month"""),
    "alerts_by_type": _with(_LONG_GOLD, f"""
        SELECT sensor_type, level, count(*) AS readings, round(avg(value) + 1e-9, 6) AS avg_value
        FROM {_JOIN_SENSOR} WHERE level = 'CRITICA' GROUP BY sensor_type, level"""),
    "daily_summary": _with(_LONG_GOLD, f"""
        SELECT year, month, day, sensor_type, max(value) AS max_value, min(value) AS min_value, count(*) AS readings
        FROM {_JOIN_BOTH.format('dim_time')} WHERE year = 1997 AND month = 6 GROUP BY ALL"""),
    # --- queries on raw readings
    "avg_by_sensor_raw": _with(_READINGS, """
        SELECT sensor_id, round(avg(value) + 1e-9, 6) AS avg_value FROM readings GROUP BY sensor_id"""),
    "avg_by_sensor_dirty": _with(_BRONZE, """
        SELECT sensor_id, round(avg(value) + 1e-9, 6) AS avg_value FROM bronze WHERE sensor_id IS NOT NULL
        GROUP BY sensor_id"""),
    "readings_by_hour_of_day": _with(_READINGS, """
        SELECT hour(ts) AS hour, count(*) AS readings FROM readings GROUP BY ALL"""),
    "count_by_raw_level": _with(_READINGS, """
        SELECT raw_level, count(*) AS readings FROM readings WHERE raw_level IS NOT NULL GROUP BY raw_level"""),
    "avg_by_type_raw": _with(_READINGS, """
        SELECT sensor_type, round(avg(value) + 1e-9, 6) AS avg_value FROM readings GROUP BY sensor_type"""),
    "critical_events_raw": _with(_READINGS, """
        SELECT * REPLACE (upper(trim(raw_level)) AS raw_level) FROM readings
        WHERE upper(trim(raw_level)) = 'CRITICA'"""),
    # --- sensor lifecycle and changing dimensions
    "sensor_validity": _with(_READINGS + ",\n" + _LIFE, """
        SELECT reading_id, sensor_id, ts, valid_from, valid_to,
          valid_from <= ts AND (valid_to IS NULL OR ts < valid_to) AS in_service
        FROM readings JOIN life USING (sensor_id)"""),
    "active_sensors": _with(_READINGS + ",\n" + _LIFE, """
        SELECT reading_id, r.sensor_type, ts, count(l.sensor_id) AS n_active
        FROM readings r LEFT JOIN life l ON r.sensor_type = l.sensor_type AND valid_from <= ts
          AND (valid_to IS NULL OR ts < valid_to)
        GROUP BY ALL"""),
    "assign_sensor": _with(_READINGS + ",\n" + _LIFE, """
        SELECT reading_id, r.sensor_type, ts, min(l.sensor_id) AS assigned_id
        FROM readings r LEFT JOIN life l ON r.sensor_type = l.sensor_type AND valid_from <= ts
          AND (valid_to IS NULL OR ts < valid_to)
        GROUP BY ALL"""),
    "assign_sensor_even": _with(_READINGS + ",\n" + _LIFE + _EVEN, "SELECT * FROM assigned"),
    "assign_sensor_shares": _with(_READINGS + ",\n" + _LIFE + _EVEN, """
        SELECT sensor_type, n_active, assigned_id, count(*) AS readings FROM assigned
        WHERE assigned_id IS NOT NULL GROUP BY ALL"""),
    "replacement_of": _with(_LIFE, """
        SELECT a.sensor_id, a.replacement_id, b.sensor_type AS replacement_type, b.valid_from AS replacement_from
        FROM life a LEFT JOIN life b ON a.replacement_id = b.sensor_id"""),
    "last_successor": """
        WITH RECURSIVE pairs AS (
          SELECT CAST(s_suppkey AS INTEGER) AS sensor_id,
            CAST(CASE WHEN s_suppkey % 10 <> 0 THEN s_suppkey + 1 WHEN s_suppkey % 100 = 0 THEN s_suppkey - 9 END
              AS INTEGER) AS replacement_id
          FROM supplier),
        sensors AS (SELECT count(*) AS n FROM pairs),
        walk AS (
          SELECT sensor_id, sensor_id AS reached, CAST(0 AS BIGINT) AS steps FROM pairs
          UNION ALL
          SELECT w.sensor_id, p.replacement_id, w.steps + 1
          FROM walk w JOIN pairs p ON p.sensor_id = w.reached, sensors
          WHERE p.replacement_id IS NOT NULL AND w.steps <= n)
        SELECT sensor_id, CASE WHEN max(steps) <= max(n) THEN arg_max(reached, steps) END AS last_id,
          CASE WHEN max(steps) <= max(n) THEN max(steps) END AS replacements
        FROM walk, sensors GROUP BY sensor_id""",
    "scd1_upsert": """
        WITH last AS (SELECT * FROM orders QUALIFY row_number() OVER (
          PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
        SELECT o_custkey AS customer, o_orderpriority AS priority, o_orderdate AS effective, o_orderkey AS change_id
        FROM last
        UNION ALL
        SELECT c_custkey, c_mktsegment, NULL, NULL FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
    "scd2_build": _with(_versions("true"), "SELECT * FROM versions"),
    # the ranges of all orders, whether they came with the first part or as updates
    "scd2_merge": _with(_versions("true"), "SELECT * EXCLUDE (version_key) FROM versions"),
    "scd2_merge_keys": _with(_versions("true"), """
        SELECT count(*) AS versions, count(*) AS numbers, CAST(0 AS BIGINT) AS moved FROM versions"""),
    # --- alerts, episodes and roll-ups
    "alert_counts": _with(_LEVELED, """
        SELECT sensor_id, sensor_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS period,
          count(*) FILTER (level <> 'NORMAL') AS alerts
        FROM leveled GROUP BY ALL"""),
    "alert_frequency": _with(_LEVELED, """
        SELECT sensor_id, level, CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, count(*) AS alerts
        FROM leveled WHERE level <> 'NORMAL' GROUP BY ALL"""),
    "alert_frequency_turbine": _with(_SHIPMENTS + ",\n" + _TURBINES, f"""
        SELECT turbine_id, {_LEVEL} AS level, CAST(date_trunc('month', ts) AS TIMESTAMP) AS period, count(*) AS alerts
        FROM shipped JOIN turbines USING (sensor_id) WHERE value > 60 GROUP BY ALL"""),
    "anomaly_episodes": _with(_LEVELED, "," + _episodes("leveled")),
    "anomaly_episodes_positions": _with(_LEVELED, "," + _episodes("leveled")),
    "anomaly_episodes_long": _with(_LONG_SILVER, "," + _episodes("silver")),
    "semi_additive": _with(_READINGS, """
        SELECT sensor_type, event_date, round(avg(value) + 1e-9, 6) AS avg_value, max(value) AS max_value
        FROM readings GROUP BY ALL"""),
    "rollup_hour": _with(_LEVELED, """
        SELECT sensor_type, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS period, count(*) AS readings,
          round(avg(value) + 1e-9, 6) AS avg_value, min(value) AS min_value, max(value) AS max_value,
          count(*) FILTER (level <> 'NORMAL') AS alerts
        FROM leveled GROUP BY ALL"""),
    "rollup_day": _with(_LEVELED, """
        SELECT sensor_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, count(*) AS readings,
          round(avg(value) + 1e-9, 6) AS avg_value, min(value) AS min_value, max(value) AS max_value,
          count(*) FILTER (level <> 'NORMAL') AS alerts
        FROM leveled GROUP BY ALL"""),
    "rollup_turbine": _with(_SHIPMENTS + ",\n" + _TURBINES, """
        SELECT turbine_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, count(*) AS readings,
          round(avg(value) + 1e-9, 6) AS avg_value, min(value) AS min_value, max(value) AS max_value,
          count(*) FILTER (value > 60) AS alerts
        FROM shipped JOIN turbines USING (sensor_id) GROUP BY ALL"""),
    # --- streaming
    "stream_alerts": _with(_BRONZE, f"""
        SELECT reading_id, sensor_id, TRY_CAST(ts AS TIMESTAMP) AS ts, value, {_LEVEL} AS level FROM bronze
        WHERE sensor_id IS NOT NULL AND TRY_CAST(ts AS TIMESTAMP) IS NOT NULL AND value > 60"""),
    "stream_alerts_by_type": _with(_BRONZE + ",\n" + _CLEAN.format(
        type="sensor_type", raw="raw_level") + ",\n" + _BANDS, """
        SELECT reading_id, sensor_type, ts, value, level FROM cleaned JOIN bands USING (sensor_type)
        WHERE value BETWEEN lo AND hi AND level <> 'NORMAL'"""),
    "stream_dedupe": _with(_SILVER, """
        SELECT DISTINCT reading_id, sensor_id, ts, sensor_type, value, level FROM silver"""),
    "stream_hourly": """
        SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start, count(*) AS readings FROM events
        GROUP BY 1""",
    "stream_sessions": _with(_LEVELED, """,
        alerts AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS opens
          FROM leveled WHERE level <> 'NORMAL' WINDOW w AS (PARTITION BY sensor_id ORDER BY ts)),
        numbered AS (SELECT *, sum(opens) OVER (PARTITION BY sensor_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session
          FROM alerts)
        SELECT sensor_id, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS readings, max(value) AS max_value,
          (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_s
        FROM numbered GROUP BY sensor_id, session"""),
}

for _suffix, _dim in (("", "dim_time"), ("_fanout", "dim_time_reading")):
    _both = _JOIN_BOTH.format(_dim)
    ORACLE |= {
        f"readings_per_hour{_suffix}": _with(_GOLD, f"""
            SELECT year, month, day, hour, count(*) AS readings FROM fact JOIN {_dim} USING (hour_key) GROUP BY ALL"""),
        f"dash_by_type{_suffix}": _with(_GOLD, f"""
            SELECT sensor_type, count(*) AS readings FROM {_both} GROUP BY sensor_type"""),
        f"dash_by_level{_suffix}": _with(_GOLD, f"SELECT level, count(*) AS readings FROM {_both} GROUP BY level"),
        f"level_share{_suffix}": _with(_GOLD, f"""
            SELECT level, count(*) AS readings, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 1) AS percent
            FROM {_both} GROUP BY level"""),
        f"dash_avg_by_sensor{_suffix}": _with(_GOLD, f"""
            SELECT sensor_id, round(avg(value) + 1e-9, 6) AS avg_value FROM {_both} GROUP BY sensor_id"""),
        f"dash_trend{_suffix}": _with(_GOLD, f"""
            SELECT ts, round(avg(value) + 1e-9, 6) AS avg_value FROM {_both} GROUP BY ts"""),
    }

_AS_OF = _with(_versions("true"), """
    SELECT o_orderkey, customer, o_orderdate AS ordered, priority, valid_from, valid_to, is_active, version_key
    FROM orders JOIN versions ON o_custkey = customer AND valid_from <= o_orderdate
      AND (valid_to IS NULL OR o_orderdate < valid_to)""")
_TWO_TYPES = _LEVELED + f""",
silver AS (SELECT sensor_id, ts, value, level, 'kind-' || coalesce(trim(raw_level), 'none') AS sensor_type
  FROM leveled),""" + _STAR
ORACLE |= {
    "join_as_of": _AS_OF,
    "join_as_of_carried": _AS_OF,
    "join_as_of_cells": _AS_OF,
    "join_as_of_few": _AS_OF,
    "service_counts": _with(_LIFE, """,
        moments AS (SELECT sensor_type, valid_from AS at FROM life WHERE valid_to IS NULL OR valid_to > valid_from
          UNION SELECT sensor_type, valid_to FROM life WHERE valid_to > valid_from)
        SELECT m.sensor_type, m.at AS valid_from,
          lead(m.at) OVER (PARTITION BY m.sensor_type ORDER BY m.at) AS valid_to, count(l.sensor_id) AS n_active
        FROM moments m LEFT JOIN life l ON l.sensor_type = m.sensor_type AND l.valid_from <= m.at
          AND (l.valid_to IS NULL OR m.at < l.valid_to)
        GROUP BY m.sensor_type, m.at"""),
    "fact_versions": _with(_SILVER + ",\n" + _LIFE + """,
history AS (
  SELECT sensor_id, sensor_type, valid_from AS effective FROM life
  UNION ALL SELECT sensor_id, 'refit-' || sensor_type, valid_to FROM life WHERE valid_to > valid_from),
versions AS (
  SELECT sensor_id, effective AS valid_from, lead(effective) OVER (PARTITION BY sensor_id ORDER BY effective) AS valid_to,
    row_number() OVER (ORDER BY sensor_id, effective) AS version_key
  FROM history)""", f"""
        SELECT coalesce(version_key, 0) AS version_key, {_HOUR_KEY.format('ts')} AS hour_key, value, level
        FROM silver s LEFT JOIN versions v ON v.sensor_id = s.sensor_id AND valid_from <= ts
          AND (valid_to IS NULL OR ts < valid_to)"""),
    "fact_two_types": _with(_TWO_TYPES, """
        SELECT sensor_key, level, count(*) AS readings FROM fact GROUP BY ALL"""),
    "fact_two_types_by_id": _with(_TWO_TYPES, """
        SELECT sensor_key, s.level, count(*) AS readings FROM silver s JOIN dim_sensor d USING (sensor_id)
        GROUP BY ALL"""),
}
ORACLE["gold_batches_versions"] = ORACLE["fact_versions"]
ORACLE["stream_hourly_increments"] = ORACLE["stream_hourly"]
ORACLE["stream_sessions_increments"] = ORACLE["stream_sessions"]
ORACLE["rollup_cells_day"] = ORACLE["rollup_day"].replace(_LEVELED, _SILVER).replace("FROM leveled", "FROM silver")
