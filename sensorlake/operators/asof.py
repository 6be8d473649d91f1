"""Point-in-time joins by equality on (key, time slice).

The time from the first to the last change is cut into slices, about as many per
key as a key has changes; a key with many more changes than others gets slices
of its own width. Versions are listed in every slice that they touch: the one
valid at its start and the changes within. So the listing has at most about three
entries a version, and a fact finds its version among a few by an equality. The
written listing is joined by its real size: below the broadcast threshold facts
stay where they are, above it they are shuffled once.

Where changes crowd into one slice of a key, its facts alone go another way: the
last version is carried forward along one order of facts and versions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .ordered import with_last

HOT = 4  # times the mean number of changes, from which on a key has its own width
CROWD = 256  # versions in one slice


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _valid(versions: DataFrame) -> DataFrame:
    # a range without any time would hide the one before it
    return versions.where("valid_from IS NOT NULL AND (valid_to IS NULL OR valid_from < valid_to)")


@dataclass(frozen=True)
class Slices:
    """Versions listed by (``_key``, ``_slice``); ``hot`` has the widths of keys with many changes."""

    key: str
    versions: DataFrame
    listed: DataFrame
    hot: DataFrame | None
    crowded: bool
    first: int
    last: int
    width: int

    def place(self, rows: DataFrame, key: str, at: Column) -> DataFrame:
        """``rows`` with ``_slice``: the slice of the time ``at``, NULL before the first change."""
        width = F.lit(self.width)
        if self.hot is not None:
            rows = rows.join(self.hot, F.col(key) == F.col("_hot"), "left").drop("_hot")
            width = F.coalesce("_width", width)
        since = F.least(at, F.lit(self.last)) - self.first
        return rows.withColumn("_slice", F.when(at >= self.first, F.floor(since / width).cast("long"))).drop("_width")


def slice_versions(versions: DataFrame, key: str) -> Slices:
    """List ``versions`` (key, valid_from, valid_to, ...) by time slices. The ranges of a key must not overlap."""
    rest = [c for c in versions.columns if c != key]
    valid = _valid(versions).where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), _micros(F.col("valid_from")).alias("_from"), _micros(F.col("valid_to")).alias("_to"),
        F.struct(*rest).alias("_version"))
    counts = valid.groupBy("_key").agg(F.count("*").alias("n"), F.min("_from").alias("first"), F.max("_from").alias("last"))
    changes, keys, first, last = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.min("first"), F.lit(0)),
        F.coalesce(F.max("last"), F.lit(0))).first()
    span, mean = last - first + 1, -(-changes // max(keys, 1)) or 1
    hot = written(counts.where(F.col("n") > HOT * mean).select(
        F.col("_key").alias("_hot"), F.ceil(F.lit(span) / F.col("n")).cast("long").alias("_width")), "hot_keys")
    hot = None if hot.isEmpty() else hot
    plan = Slices(key, versions, valid, hot, False, first, last, -(-span // mean))
    until = F.coalesce(F.col("_to") - 1, F.lit(last))
    begun = plan.place(valid, "_key", F.col("_from")).withColumnRenamed("_slice", "_begin")
    listed = plan.place(begun, "_key", until).withColumn("_slice", F.explode(F.sequence("_begin", "_slice")))
    sizes = listed.groupBy("_key", "_slice").agg(F.count("*").alias("n")).where(F.col("n") > CROWD)
    crowds = written(sizes.select("_key", "_slice"), "crowded_slices")
    crowded = not crowds.isEmpty()
    if crowded:
        listed = listed.join(crowds, ["_key", "_slice"], "left_anti")
    found = listed.groupBy("_key", "_slice").agg(F.collect_list("_version").alias("_found"))
    if crowded:
        found = found.unionByName(crowds, allowMissingColumns=True)
    return Slices(key, versions, written(found, "slices"), hot, crowded, first, last, plan.width)


def join_slices(fact: DataFrame, sliced: Slices, key: str, ts: str, how: str) -> DataFrame:
    """``fact`` with the columns of the version of its ``key`` valid at ``ts``."""
    at = F.col(ts).cast("timestamp")
    placed = sliced.place(fact, key, _micros(at))
    listed = sliced.listed.withColumnRenamed("_slice", "_at_slice")
    joined = placed.join(listed, (F.col(key) == F.col("_key")) & (F.col("_slice") == F.col("_at_slice")), "left")
    valid = F.filter("_found", lambda v: (v["valid_from"] <= at) & (v["valid_to"].isNull() | (at < v["valid_to"])))
    found = joined.withColumn("_version", F.get(valid, F.lit(0)))
    here = found if how == "left" else found.where("_version IS NOT NULL")
    if not sliced.crowded:
        return here.select(*fact.columns, "_version.*")
    crowd = F.col("_key").isNotNull() & F.col("_found").isNull()
    other = carry_forward(found.where(crowd).select(*fact.columns), sliced.versions, key, ts, how, sliced.key)
    return here.where(~crowd).select(*fact.columns, "_version.*").unionByName(other)


def carry_forward(fact: DataFrame, versions: DataFrame, key: str, ts: str, how: str, version_key: str | None = None) -> DataFrame:
    """The same join along one global order of facts and versions, whatever the number of versions of a key."""
    name = version_key or key
    facts = fact.select(
        F.col(key).alias("_key"), F.col(ts).alias("_at"), F.lit(1).alias("_is_fact"),
        F.xxhash64(*fact.columns).alias("_spread"), F.struct(*fact.columns).alias("_fact"))
    starts = _valid(versions).select(
        F.col(name).alias("_key"), F.col("valid_from").alias("_at"), F.lit(0).alias("_is_fact"),
        F.lit(0).cast("bigint").alias("_spread"),
        F.struct(*[c for c in versions.columns if c != name]).alias("_version"))
    both = facts.unionByName(starts, allowMissingColumns=True)
    placed = with_last(both, ["_key", "_at", "_is_fact", "_spread"], "_key", F.col("_version"), "_last").where("_is_fact = 1")
    valid = F.col("_last.valid_to").isNull() | (F.col("_at") < F.col("_last.valid_to"))
    found = placed.withColumn("_last", F.when(valid, F.col("_last")))
    if how == "inner":
        found = found.where("_last IS NOT NULL")
    return found.select("_fact.*", "_last.*")
