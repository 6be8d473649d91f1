"""Quality figures of a frame, each in one distributed pass."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TIMES = ("timestamp", "timestamp_ntz")
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", *_TIMES)


def _is_number(dtype: str) -> bool:
    return dtype in _NUMBERS or dtype.startswith("decimal")


_QUARTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75}


def _missing(name: str, dtype: str) -> Column:
    missing = F.col(name).isNull()
    return missing | F.isnan(name) if dtype in ("float", "double") else missing


def _long(columns: list[str], value_type: str) -> Column:
    """The columns as an array of (column, value), to be exploded."""
    return F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast(value_type).alias("value")) for c in columns]))


def null_counts(df: DataFrame, rows: str | None = None) -> DataFrame:
    """One row per column: how many values are NULL or NaN; with ``rows`` also the number of rows, in that column."""
    whole = [F.struct(F.count("*").alias("value")).alias("_rows")] if rows else []
    counts = df.agg(*[F.count_if(_missing(c, t)).alias(c) for c, t in df.dtypes], *whole)
    found = [F.col("_rows.value").alias(rows)] if rows else []
    return counts.select(_long(df.columns, "bigint").alias("_c"), *found).select(
        "_c.column", F.col("_c.value").alias("nulls"), *([rows] if rows else []))


def quality_report(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Null counts of bronze, with the row counts of both layers on every row."""
    return null_counts(bronze, "bronze_rows").withColumn("silver_rows", silver.agg(F.count("*")).scalar())


def _describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    values = (
        df.select(_long(columns, "string").alias("c")).select("c.column", "c.value")
        .groupBy("column", "value").agg(F.count("*").alias("n"))
    )
    known = F.col("value").isNotNull()
    # the most frequent value, the smallest one among equals
    top = F.min(F.when(known, F.struct((-F.col("n")).alias("rank"), F.col("value").alias("value"))))
    return values.groupBy("column").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("count"),
        F.count("value").alias("unique"),
        top.alias("top"),
    ).select("column", "count", "unique", F.col("top.value").alias("top"), (-F.col("top.rank")).alias("freq"))


_ACCURACY = 10_000
_FEW = 20_000  # rows in a window of values that are looked at one by one


@dataclass
class _Rank:
    """The search for the values of ranks ``below`` and ``above`` of a column, within [lo, hi]."""

    column: str
    share: float
    below: int
    above: int
    lo: float
    hi: float
    before: int  # values less than lo
    inside: int
    margin: float = 2 / _ACCURACY
    stuck: bool = False  # so many equal values that no window is smaller

    def narrowed(self) -> tuple[float, float]:
        """Shares of the window's values between which both ranks should lie."""
        return (max(0.0, (self.below - self.before) / self.inside - self.margin),
                min(1.0, (self.above + 1 - self.before) / self.inside + self.margin))

    def done(self) -> bool:
        return self.stuck or self.lo == self.hi or self.inside <= _FEW


def _quartiles(df: DataFrame, values: dict[str, Column], sizes: dict[str, tuple]) -> dict[str, dict[str, float]]:
    """Exact interpolated quartiles, by windows of values that shrink around the wanted ranks.

    A pass over the frame estimates for all columns at once between which values
    the ranks lie, and the next one counts what is below and inside; a window
    that misses its ranks is widened. Each pass narrows windows some thousandfold,
    until they hold few rows or one value, and only those rows are counted by value.
    """
    ranks = []
    for column, (n, lo, hi) in sizes.items():
        for share in _QUARTILES.values():
            spot = (n - 1) * share
            ranks.append(_Rank(column, share, math.floor(spot), math.ceil(spot), lo, hi, 0, n))
    while open_ := [r for r in ranks if not r.done()]:
        estimates = df.agg(*[F.percentile_approx(
            F.when(values[r.column].between(r.lo, r.hi), values[r.column]), list(r.narrowed()), _ACCURACY).alias(str(k))
            for k, r in enumerate(open_)]).first()
        counts = df.agg(*chain.from_iterable(
            (F.count_if(values[r.column] < lo).alias(f"before{k}"), F.count_if(values[r.column].between(lo, hi)).alias(f"inside{k}"))
            for k, (r, (lo, hi)) in enumerate(zip(open_, estimates, strict=True)))).first()
        for k, (r, (lo, hi)) in enumerate(zip(open_, estimates, strict=True)):
            before, inside = counts[f"before{k}"], counts[f"inside{k}"]
            if before <= r.below and r.above < before + inside and inside < r.inside:
                r.lo, r.hi, r.before, r.inside = lo, hi, before, inside
            else:
                r.margin *= 4
                r.stuck = r.margin > 1
    found = {(r.column, r.share): {} for r in ranks}
    wanted = F.array(*[
        F.when(values[r.column].between(r.lo, r.hi), F.struct(F.lit(k).alias("k"), values[r.column].alias("value")))
        for k, r in enumerate(ranks)])
    counted = df.select(F.explode(F.filter(wanted, lambda w: w.isNotNull())).alias("w")).groupBy("w.k", "w.value").agg(
        F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("k").orderBy("value"))
    targets = F.array(*[F.array(F.lit(r.below - r.before), F.lit(r.above - r.before)).cast("array<bigint>") for r in ranks])
    held = counted.withColumns({"last": upto - 1, "first": upto - F.col("n"), "targets": F.get(targets, F.col("k"))})
    for row in held.where(F.exists("targets", lambda t: (F.col("first") <= t) & (t <= F.col("last")))).collect():
        r = ranks[row.k]
        for rank, target in ((r.below, row.targets[0]), (r.above, row.targets[1])):
            if row.first <= target <= row.last:
                found[r.column, r.share][rank] = row.value
    out: dict[str, dict[str, float]] = {column: {} for column in sizes}
    for r in ranks:
        lower, upper = found[r.column, r.share][r.below], found[r.column, r.share][r.above]
        name = next(name for name, share in _QUARTILES.items() if share == r.share)
        out[r.column][name] = lower + (upper - lower) * ((sizes[r.column][0] - 1) * r.share - r.below)
    return out


def _describe_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Moments of all columns in one pass, and exact quartiles; one row per column with any value."""
    value = {c: F.col(c).cast("double") for c in columns}
    value = {c: F.nanvl(v, F.lit(None).cast("double")) for c, v in value.items()}
    figures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[f(v).alias(f"{k}_{name}") for k, v in enumerate(value.values()) for name, f in figures.items()]).first()
    moments = {c: {name: row[f"{k}_{name}"] for name in figures} for k, c in enumerate(columns) if row[f"{k}_count"]}
    quartiles = _quartiles(df, value, {c: (m["count"], m["min"], m["max"]) for c, m in moments.items()}) if moments else {}
    names = [*figures, *_QUARTILES]
    return df.sparkSession.createDataFrame(
        [(c, *(({**m, **quartiles[c]})[name] for name in names)) for c, m in moments.items()],
        "column string, count bigint, " + ", ".join(f"{name} double" for name in names[1:]))


def describe_all(df: DataFrame) -> DataFrame:
    """One row per column: count, unique, top, freq, mean, std, min, quartiles, max.

    Numbers have moments and quartiles, and so have times, in seconds since
    1970. Everything else counts as text. Figures that do not apply are NULL.
    """
    seconds = {c: F.unix_micros(F.col(c).cast("timestamp")) / F.lit(1e6) for c, t in df.dtypes if t in _TIMES}
    df = df.withColumns(seconds) if seconds else df
    numbers = [c for c, t in df.dtypes if _is_number(t)]
    texts = [c for c, t in df.dtypes if not _is_number(t)]
    parts = []
    if texts:
        parts.append(_describe_text(df, texts))
    if numbers:
        parts.append(_describe_numbers(df, numbers))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # a column without any value has a row too; one row per column of the frame
    every = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, df.columns))).alias("column"))
    both = every.join(both, "column", "left").fillna(0, ["count"])
    if texts:
        both = both.withColumn("unique", F.when(F.col("column").isin(texts), F.coalesce("unique", F.lit(0))))
    figures = {
        "count": "bigint", "unique": "bigint", "top": "string", "freq": "bigint", "mean": "double",
        "std": "double", "min": "double", "q25": "double", "q50": "double", "q75": "double", "max": "double",
    }
    return both.select("column", *[
        (F.col(c) if c in both.columns else F.lit(None)).cast(t).alias(c) for c, t in figures.items()])
