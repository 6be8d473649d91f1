"""Quality rules whose thresholds come from quantile sketches per language and source.

The sketch of a measure is a histogram with bins of equal relative width: a
whole number keeps its five leading bits, so a bin is at most 1/16 of its value
wide. Sketches merge by adding counts, in any order and with the same result,
which makes the aggregate partial in each task: a source with a third of all
rows sends one row per bin and task. Its size is bounded by the number of bins.

A document fails a rule if its measure lies beyond a fence around the middle
half of its group, ``[q25 - reach * spread, q75 + reach * spread]``. The spread
is the distance between quartiles, at least ``LEAST_SPREAD``: a group in which
nearly all documents agree, or that is small, does not reject the slightly
different. So usual documents stay whatever their group is, and no fixed share
of a group is dropped. The thresholds are joined to the documents by group.

Defined cases: NULL text has no words and fails the base rules; NULL language or
source is a group of its own; rows are judged one by one, so repeated ids are
fine; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import no_null, stored, table

REACH = 4
_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# measures per 1000 words (characters per word: times 1000), and the least spread of each
LEAST_SPREAD = {"chars": 500, "symbols": 20, "lines": 10, "repeats": 50}
_LEADING_BITS = 5


def _repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    base = len(number)
    if base < 2_000_000:
        window = (codes[:-2] * base + codes[1:-1]) * base + codes[2:]
    else:  # more words than three fit into 64 bits: number the pairs first
        _, pair = np.unique(codes[:-1] * base + codes[1:], return_inverse=True)
        window = pair[:-1] * base + codes[2:]
    _, which, count = np.unique(window, return_inverse=True, return_counts=True)
    twice = count[which] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift:n - 2 + shift] |= twice
    return int(inside.sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    """The figures named in ``BASE``."""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return (
        len(words), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, _SYMBOLS)),
        len(lines) - len(set(lines)), _repeated_words(words))


@F.pandas_udf(StructType([StructField(name, LongType()) for name in BASE]))
def _measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(t) for t in batch], columns=list(BASE), dtype="int64")


def _bin(value: Column) -> Column:
    """The least number with the same leading bits, at most five."""
    shift = F.greatest(F.length(F.bin(value)) - _LEADING_BITS, F.lit(0))
    return value - value % F.pow(F.lit(2.0), shift).cast("long")


def _rates() -> dict[str, Column]:
    words = F.col("n_words")
    rate = lambda name, by: F.when(words > 0, F.floor(F.lit(by) * F.col(name) / words)).cast("long")
    return {"chars": rate("word_chars", 1000), "symbols": rate("n_symbols", 1000),
            "lines": rate("n_dup_lines", 1000), "repeats": rate("n_repeat_words", 1000)}


def thresholds(measured: DataFrame) -> DataFrame:
    """Per language, source and measure: the quartiles of its sketch, and the fence (lo, hi) around them."""
    pairs = F.explode(F.create_map(*[x for name in LEAST_SPREAD for x in (F.lit(name), F.col(name))]))
    sketch = (
        measured.where("n_words > 0").select("lang", "source", pairs.alias("measure", "value"))
        .groupBy("lang", "source", "measure", _bin(F.col("value")).alias("bin")).agg(F.count("*").alias("n")))
    group = ("lang", "source", "measure")
    # at most a few hundred bins per group, whatever the number of documents
    upto = Window.partitionBy(*group).orderBy("bin")
    ranked = sketch.withColumns({
        "upto": F.sum("n").over(upto), "total": F.sum("n").over(Window.partitionBy(*group))})
    quantile = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), F.col("bin")))
    least = F.create_map(*[x for k, v in LEAST_SPREAD.items() for x in (F.lit(k), F.lit(v))])
    spread = F.greatest(F.col("q75") - F.col("q25"), least[F.col("measure")])
    return ranked.groupBy(*group).agg(quantile(1).alias("q25"), quantile(3).alias("q75")).withColumns({
        "lo": F.col("q25") - REACH * spread, "hi": F.col("q75") + REACH * spread})


def judged(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, lang, source) with their base figures, ``base_failed`` and ``kept``."""
    figures = docs.select("doc_id", "lang", "source", _measures(no_null(F.col("text"))).alias("m"))
    # read twice, for the sketches and for the verdicts: the figures are stored, not the texts
    measured = stored(figures.select("doc_id", "lang", "source", "m.*").withColumns(_rates()), "quality")
    fences = thresholds(measured).groupBy("lang", "source").pivot("measure", list(LEAST_SPREAD)).agg(
        F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    fences = fences.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    usual = F.lit(True)
    for name in LEAST_SPREAD:
        usual = usual & (F.col(name) <= F.col(f"{name}_hi"))
    usual = usual & (F.col("chars") >= F.col("chars_lo"))
    return measured.join(fences, same, "left").select(
        "doc_id", *BASE, failed.alias("base_failed"), (~failed & F.coalesce(usual, F.lit(False))).alias("kept"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of every whole document."""
    return judged(table(spark, sf_dir, "documents"))
