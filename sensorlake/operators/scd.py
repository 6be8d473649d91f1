"""Slowly changing dimensions and point-in-time joins.

Version ranges are half-open, [valid_from, valid_to); the open version has no
end and is the active one. Keys and effective times must not be NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .asof import Slices, join_slices, slice_versions
from ..session import written
from .ordered import beside, in_parts, running, with_position


def valid_at(ts: Column, start: Column, end: Column) -> Column:
    """Half-open validity; a missing end means still valid."""
    return (start <= ts) & (end.isNull() | (ts < end))


def _latest(df: DataFrame, keys: Sequence[str], attrs: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The attributes of the last row per key, collapsed inside each task before the shuffle."""
    last = F.max_by(F.struct(*attrs), F.struct(*by)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{a}").alias(a) for a in attrs])


def _versions(states: DataFrame, key: str, attrs: Sequence[str], number: str | None = None) -> DataFrame:
    """Version ranges of states (key, _from, attrs), one per key and time; consecutive equal states are one version.

    With ``number`` a version has the least number of its states. Rows are
    dealt by key and sorted once.
    """
    now = F.struct(*attrs)
    states, by = in_parts(states, key, "_from")
    opens = F.col("_before").isNull() | ~F.col("_before").eqNullSafe(now)
    flagged = beside(states, by, "_from", now, "_before", -1).withColumn("_opens", opens.cast("int")).drop("_before")
    if number:
        flagged = running(flagged, by, ["_from"], "_opens", "_run")
        if len(by) == 1:
            # a key of at most PART rows; they are already dealt by it
            least = F.min(number).over(Window.partitionBy(key, "_run"))
            opened = flagged.where(F.col(key).isNotNull()).withColumn(number, least).where("_opens = 1")
        else:
            least = flagged.groupBy(key, "_run").agg(F.min(number).alias("_least"))
            opened = flagged.where("_opens = 1").drop(number).join(least, [key, "_run"]).withColumnRenamed("_least", number)
    else:
        opened = flagged.where("_opens = 1")
    ranges = beside(opened, by, "_from", F.col("_from"), "valid_to", +1)
    return ranges.select(
        key, *attrs, F.col("_from").alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_active"),
        *([number] if number else []))


def scd2_build(history: DataFrame, key: str, attrs: Sequence[str], effective: str, tie: str,
               surrogate: str = "version_key") -> DataFrame:
    """Version ranges from a change history, numbered by key and time as BIGINT.

    Of several rows with the same key and effective time the one with the
    greatest ``tie`` counts; consecutive equal versions become one.
    """
    states = _latest(history, [key, effective], attrs, [tie]).withColumnRenamed(effective, "_from")
    return with_position(_versions(states, key, attrs), [key, "valid_from"], surrogate)


def change_points(history: DataFrame, key: str, attrs: Sequence[str], effective: str, tie: str,
                  number: str = "version_key") -> DataFrame:
    """Every observed state of a history (key, effective, attrs, tie, number), also those that changed nothing.

    This is what later updates are merged into: a state that equals the one
    before it makes no version today, but does once a late update comes between.
    """
    states = _latest(history, [key, effective], [*attrs, tie], [tie])
    return with_position(states, [key, effective], number).select(key, effective, *attrs, tie, number)


def merge_points(points: DataFrame, updates: DataFrame, key: str, attrs: Sequence[str], effective: str, tie: str,
                 number: str = "version_key", highest: int | None = None) -> DataFrame:
    """``points`` with all updates among them, whether they come in order, late or twice.

    At one key and time the state with the greatest ``tie`` counts, an update
    before a known one. A known state keeps its number; new ones follow
    ``highest``, by default the greatest number of ``points``.
    """
    known, new = merged_parts(points, updates, key, attrs, effective, tie, number, highest)
    return known.unionByName(new)


def merged_parts(points: DataFrame, updates: DataFrame, key: str, attrs: Sequence[str], effective: str, tie: str,
                 number: str = "version_key", highest: int | None = None, bucket: Column | None = None,
                 ) -> tuple[DataFrame, DataFrame]:
    """``merge_points`` as the known states and the new ones. What is merged is written once, for both.

    With ``bucket``, a column made of the key, the states have it as ``bucket``
    and the written files of the known ones lie in its order, each in a few buckets.
    """
    state = F.struct(*attrs, tie)
    coming = _latest(updates, [key, effective], [*attrs, tie], [tie]).select(
        key, effective, state.alias("_state"), F.lit(None).cast("bigint").alias(number), F.lit(1).alias("_update"))
    known = points.select(key, effective, state.alias("_state"), number, F.lit(0).alias("_update"))
    both, by = known.unionByName(coming), [key, effective]
    if bucket is not None:
        # one known state and one update at most are equal in these, so no range is larger than others
        by = ["bucket", *by]
        both = both.withColumn("bucket", bucket).repartitionByRange(*by)
    merged = both.groupBy(*by).agg(
        F.max_by("_state", F.struct(f"_state.{tie}", "_update")).alias("_state"), F.max(number).alias(number))
    merged = written(merged.select(*by, "_state.*", number), "merged")
    if highest is None:
        highest = points.agg(F.coalesce(F.max(number), F.lit(0)).cast("bigint")).scalar()
    new = with_position(merged.where(F.col(number).isNull()).drop(number), [key, effective], number)
    return merged.where(F.col(number).isNotNull()), new.withColumn(number, F.col(number) + highest)


def versions_of(points: DataFrame, key: str, attrs: Sequence[str], effective: str, number: str = "version_key") -> DataFrame:
    """The version ranges of change points; a version has the least number of its states.

    A version so keeps its number when states are merged in: one that is split
    keeps it for the part with its first-known state, and the other part has
    the least number of its own states, which no version had before.
    """
    states = points.select(key, F.col(effective).alias("_from"), *attrs, number)
    return _versions(states, key, attrs, number)


def scd1_upsert(dim: DataFrame, updates: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Overwrite rows by key and add new ones; ``order`` picks the last of several updates."""
    updates = _latest(updates, [key], [c for c in updates.columns if c != key], order)
    kept = dim.join(updates.select(key).distinct(), key, "left_anti")
    return kept.unionByName(updates.select(*dim.columns))


def insert_absent(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The ``rows`` whose key ``target`` lacks, one per key, ready to be appended."""
    rest = [c for c in rows.columns if c != key]
    single = _latest(rows, [key], rest, rest) if rest else rows.distinct()
    return single.join(target.select(key).distinct(), key, "left_anti").select(*rows.columns)


def join_as_of(fact: DataFrame, versions: DataFrame | Slices, key: str, ts: str, how: str = "inner",
               cell: str | None = None, few: bool = False) -> DataFrame:
    """Join every fact to the version of its key that was valid at its time.

    The ranges of a key must not overlap. By default versions are listed by
    time slices, see ``asof``, and facts join on (key, slice) by equality. Pass
    the result of ``slice_versions`` to list them once for several joins.

    ``few=True`` is for dimensions with a handful of versions per key: an
    equality on the key with the validity as a further condition, so each fact
    meets all versions of its key. Versions read from small files are then
    broadcast and the facts stay where they are.

    ``cell`` ("month", "day", ...) lists versions once per time cell they touch
    and joins on (key, cell). The listing grows with the time span, hence it is
    never broadcast on the size of the unlisted versions.

    ``how`` is "inner" or "left".
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join {how!r}")
    if isinstance(versions, Slices) or (cell is None and not few):
        return join_slices(fact, versions if isinstance(versions, Slices) else slice_versions(versions, key), key, ts, how)
    if few:
        listed = versions.withColumnRenamed(key, "_key")
        same = F.col(key) == F.col("_key")
    else:
        horizon = fact.agg(F.date_trunc(cell, F.max(ts))).scalar()
        start = F.date_trunc(cell, F.col("valid_from"))
        end = F.coalesce(F.date_trunc(cell, F.col("valid_to")), horizon)
        listed = (
            versions.withColumnRenamed(key, "_key")
            .withColumns({"_start": start, "_end": F.least(end, horizon)}).where(F.col("_start") <= F.col("_end"))
            .withColumn("_cell", F.explode(F.sequence("_start", "_end", F.expr(f"interval 1 {cell}"))))
            .drop("_start", "_end").hint("merge")
        )
        fact = fact.withColumn("_fact_cell", F.date_trunc(cell, F.col(ts)))
        same = (F.col(key) == F.col("_key")) & (F.col("_fact_cell") == F.col("_cell"))
    valid = valid_at(F.col(ts), F.col("valid_from"), F.col("valid_to"))
    return fact.join(listed, same & valid, how).drop("_key", "_cell", "_fact_cell")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns are matched by name and missing ones are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
