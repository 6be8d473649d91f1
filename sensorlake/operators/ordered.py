"""Positions, totals and neighbours along a global order.

None of these gathers the data, or one key's data, into a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir, written

PART = 1 << 20  # rows of one key that a task sorts; keys with more are cut into parts
_INDEX_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def _sorted_parts(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned and sorted, with ``_part`` and ``_index`` in the partition.

    The bounds of a range partitioning come from a sample, so two evaluations
    may cut differently. The checkpoint pins one outcome for all later reads,
    also after an executor is lost.
    """
    shared_dir(df.sparkSession)
    pinned = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    row = F.monotonically_increasing_id()
    return pinned.withColumns({
        "_part": F.shiftright(row, _INDEX_BITS),
        "_index": row.bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)),
    })


def _with_base(parts: DataFrame, amount: Column) -> DataFrame:
    """Add ``_base``: the total of ``amount`` over all earlier partitions."""
    sizes = parts.groupBy("_part").agg(F.sum(amount).alias("_size"))
    # one row per partition, so neither the window nor the broadcast grows with the rows
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))
    return parts.join(F.broadcast(bases), "_part")


def with_position(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows 1, 2, ... in the given order, which must tell all rows apart."""
    numbered = _with_base(_sorted_parts(df, order), F.lit(1))
    return numbered.withColumn(name, F.col("_base") + F.col("_index") + 1).drop("_part", "_index", "_base")


def with_surrogate_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Like ``with_position``, as an INT key for dimensions."""
    return with_position(df, order, name).withColumn(name, F.col(name).cast("int"))


def with_neighbour(numbered: DataFrame, position: str, key: str, value: Column, name: str, step: int) -> DataFrame:
    """Add ``value`` of the row ``step`` positions on, NULL if that row has another ``key``.

    ``numbered`` comes from ``with_position`` ordered by ``key`` first, so the
    neighbours of a key stand next to each other and are found by an equality
    on the position. A window over the key would bring a key with a third of
    all rows into one task; positions spread evenly.
    """
    neighbour = numbered.select((F.col(position) - step).alias(position), key, value.alias(name))
    return numbered.join(neighbour, [position, key], "left")


def with_running_total(df: DataFrame, order: Sequence[str], amount: str, name: str) -> DataFrame:
    """Add the total of ``amount`` over all rows up to and including this one."""
    parts = _with_base(_sorted_parts(df, order), F.col(amount))
    upto = Window.partitionBy("_part").orderBy("_index").rowsBetween(Window.unboundedPreceding, 0)
    total = F.col("_base") + F.sum(amount).over(upto)
    return parts.withColumn(name, total).drop("_part", "_index", "_base")


def with_last(df: DataFrame, order: Sequence[str], key: str, value: Column, name: str) -> DataFrame:
    """Add ``value`` of the last row up to this one that has any, NULL if that row has another ``key``.

    ``order`` starts with ``key``. What a partition ends with is carried into
    the next ones through a table with one row per partition, so a key may
    stretch over any number of them. Rows may tie where it does not matter
    which comes first.
    """
    marked = df.withColumn(name, F.when(value.isNotNull(), F.struct(F.col(key).alias("key"), value.alias("value"))))
    parts, seen = _sorted_parts(marked, order), F.col(name)
    ends = parts.where(seen.isNotNull()).groupBy("_part").agg(F.max_by(seen, "_index").alias("_end"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("_part").distinct().join(ends, "_part", "left").select(
        "_part", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    upto = Window.partitionBy("_part").orderBy("_index").rowsBetween(Window.unboundedPreceding, 0)
    last = parts.withColumn(name, F.last(seen, ignorenulls=True).over(upto)).join(
        F.broadcast(carried), "_part").withColumn(name, F.coalesce(name, "_carried"))
    same = F.col(f"{name}.key") == F.col(key)
    return last.withColumn(name, F.when(same, F.col(f"{name}.value"))).drop("_part", "_index", "_carried")


def in_parts(df: DataFrame, key: str, at: str) -> tuple[DataFrame, list[str]]:
    """``df`` and the columns to deal it by so that no key is sorted in one task.

    A key with more than ``PART`` rows is cut at quantiles of the timestamp
    ``at`` into ``_part``s, numbered in order; there the columns are the key and
    the part, else the key alone. The cuts are written down, so every later
    reading of the frame cuts alike.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > PART)
    hot = written(sizes.select(F.col(key).alias("_key"), F.ceil(F.col("_n") / PART).alias("_n")), "hot_keys")
    if hot.isEmpty():
        return df, [key]
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    parts = hot.agg(F.max("_n")).first()[0]
    # all hot keys are cut at the same shares, as finely as the largest needs
    cuts = written(df.join(hot, F.col(key) == F.col("_key")).groupBy("_key").agg(
        F.percentile_approx(micros, [i / parts for i in range(1, parts)], 100 * parts).alias("_cuts")), "cuts")
    cut = F.size(F.filter("_cuts", lambda c: c <= micros))
    return df.join(cuts, F.col(key) == F.col("_key"), "left").withColumn("_part", F.coalesce(cut, F.lit(0))).select(
        *df.columns, "_part"), [key, "_part"]


def beside(df: DataFrame, by: Sequence[str], at: str, value: Column, name: str, step: int) -> DataFrame:
    """Add ``value`` of the row before (-1) or after (+1) of the same key along ``at``; NULL at a key's end.

    ``by`` comes from ``in_parts``. Rows at the edge of a part get their
    neighbour from the part beside it, of which one row is looked at.
    """
    beyond, edge = (F.lag, F.max_by) if step < 0 else (F.lead, F.min_by)
    here = df.withColumn("_beside", beyond(F.struct(value.alias("value"))).over(Window.partitionBy(*by).orderBy(at)))
    if len(by) > 1:
        ends = df.groupBy(*by).agg(edge(F.struct(value.alias("value")), F.col(at)).alias("_edge"))
        carried = ends.select(*by, beyond("_edge").over(Window.partitionBy(by[0]).orderBy(by[1])).alias("_edge"))
        here = here.join(carried, list(by)).withColumn("_beside", F.coalesce("_beside", "_edge"))
    return here.select(*df.columns, F.col("_beside.value").alias(name))


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], amount: str, name: str) -> DataFrame:
    """Add the total of ``amount`` over the rows of the same key up to and including this one.

    Each part is sorted by itself; its total is carried into the key's later ones.
    """
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    here = df.withColumn(name, F.sum(amount).over(upto))
    if len(by) > 1:
        earlier = Window.partitionBy(by[0]).orderBy(by[1]).rowsBetween(Window.unboundedPreceding, -1)
        sums = df.groupBy(*by).agg(F.sum(amount).alias("_sum"))
        bases = sums.select(*by, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
        here = here.join(bases, list(by)).withColumn(name, F.col(name) + F.col("_base"))
    return here.select(*df.columns, name)
