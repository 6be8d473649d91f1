"""Maximal periodic runs of words, by block convolution at dyadic scales.

A run is a stretch of words that repeats its first ``period`` words at least
twice and that no neighbouring word extends. At the scale of block length
B = 1, 2, 4, ... the text is cut into blocks of B words, and periods from
2B - 1 to 4B - 2 are looked for: the first period of such a run holds a whole
block, and the block occurs again one period further on. The sum of squared
differences between a block and every place of its following window,
sum(x^2) + sum(t^2) - 2 sum(xt), is zero at just these places. The cross terms
come from a number-theoretic transform modulo a prime, in whole numbers; a place
where the sum is zero modulo the prime is compared word by word. Distances to
occurrences then seed runs, which are extended to the left and right.

Two rules keep the seeds few. Neighbouring blocks with occurrences at one
distance extend to the same run, so the first of them stands for all. A seed
whose block and occurrence lie in one known run of a period of at most B words
is left out: by the theorem of Fine and Wilf its distance is not the smallest
period. Runs of smaller periods are known from the scales before.

Defined cases: NULL and empty texts and texts of white space have no words, no
runs and an empty collapsed text; rows of one id and text get the same result
and are returned as often as they come in, NULL ids too; an empty table gives no
rows; other columns are ignored. Texts are read whole; the work for a text of n
words grows with n log^2 n and the lengths of its runs, and memory with n.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import no_null, small_batches, table

LEAST = 12  # words in a run
_PRIME, _ROOT = 2013265921, 31  # 15 * 2^27 + 1, so transforms of up to 2^27 places
_P = np.uint64(_PRIME)
_32 = np.uint64(32)
_CELLS = 1 << 17  # numbers transformed at once
_STEP = 1024  # words compared at once in an extension
_BATCH_WORDS = 1 << 18
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@cache
def _twiddles(length: int, inverse: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per stage, from half = length / 2 down to 1, the powers of the root and their quotients by the prime."""
    root = pow(_ROOT, (_PRIME - 1) // length, _PRIME)
    if inverse:
        root = pow(root, _PRIME - 2, _PRIME)
    powers = np.ones(max(length // 2, 1), np.uint64)
    known = 1
    while known < len(powers):
        powers[known:2 * known] = powers[:known] * np.uint64(pow(root, known, _PRIME)) % _P
        known *= 2
    stages = []
    step = 1
    while step < length:
        w = powers[::step][:length // 2 // step, None].copy()
        stages.append((w, (w << _32) // _P))
        step *= 2
    return stages


def _times(x: np.ndarray, w: np.ndarray, quotient: np.ndarray) -> np.ndarray:
    """x * w modulo the prime, by the quotient of w known beforehand."""
    r = x * w
    r -= ((x * quotient) >> _32) * _P
    return np.minimum(r, r - _P, out=r)


def _forward(x: np.ndarray, inverse: bool = False, done: int = 0) -> np.ndarray:
    """Transform of the columns of x (length, columns), in bit-reversed order; the first ``done`` stages are done."""
    length, columns = x.shape
    for w, quotient in _twiddles(length, inverse)[done:]:
        half = len(w)
        pairs = x.reshape(-1, 2, half, columns)
        u, v = pairs[:, 0], pairs[:, 1]
        difference = _P - v
        difference += u
        u += v
        np.minimum(u, u - _P, out=u)
        pairs[:, 1] = _times(difference, w, quotient)
    return x


def _backward(x: np.ndarray) -> np.ndarray:
    """The first half of the inverse of ``_forward``, but for the factor of the length."""
    length, columns = x.shape
    for w, quotient in reversed(_twiddles(length, True)):
        half = len(w)
        pairs = x.reshape(-1, 2, half, columns)
        u, v = pairs[:, 0], _times(pairs[:, 1], w, quotient)
        if 2 * half < length:
            difference = _P - v
            difference += u
            np.minimum(difference, difference - _P, out=pairs[:, 1])
        u += v
        np.minimum(u, u - _P, out=u)
    return x[:length // 2]


def _occurrences(code: np.ndarray, squares: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``begin``, distance) where the squared differences from a block's words are zero modulo the prime.

    ``squares`` are the sums of the squares before each word, ``end`` is the end
    of the block's text; distances run from 2 size - 1 to 4 size - 2.
    """
    length, places = 4 * size, 2 * size
    # the block fills a quarter, so the first two stages only multiply it; by inverse roots it comes out mirrored
    x = np.empty((4, size, len(begin)), np.uint64)
    x[0] = code[begin + np.arange(size)[:, None]]
    (w, quotient), (w2, quotient2) = _twiddles(length, True)[:2]
    x[1] = _times(x[0], w2, quotient2)
    x[2] = _times(x[0], w[:size], quotient[:size])
    x[3] = _times(x[2], w2, quotient2)
    x = _forward(x.reshape(length, -1), inverse=True, done=2)
    t = np.zeros((length, len(begin)), np.uint64)
    at = begin + (2 * size - 1) + np.arange(3 * size - 1)[:, None]
    np.take(code, at, mode="clip", out=t[:3 * size - 1])
    # nothing beyond the text equals a word, whose codes begin with 1
    beyond = np.flatnonzero(at[-1] >= end)
    t[:3 * size - 1, beyond] *= at[:, beyond] < end[beyond]
    x *= _forward(t)
    x %= _P
    factor = 2 * pow(length, _PRIME - 2, _PRIME) % _PRIME
    cross = _times(_backward(x), np.uint64(factor), np.uint64((factor << 32) // _PRIME))
    sums = squares[np.minimum(begin + (2 * size - 1) + np.arange(3 * size)[:, None], end)]
    total = (squares[begin + size] - squares[begin]) + sums[size:] - sums[:places]
    distance, place = np.nonzero(total % _P == cross)
    return place, distance + (2 * size - 1)


def _equal(code: np.ndarray, i: np.ndarray, j: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """How many words are equal from i and j on, in steps of ``way``, ``room`` at most."""
    n, active, step = np.zeros(len(i), np.int64), np.flatnonzero(room > 0), 4
    last = len(code) - 1
    while len(active):
        still = []
        for part in np.array_split(active, len(active) * step // (1 << 18) + 1):
            k = np.arange(step)
            left = np.clip(i[part, None] + way * (n[part, None] + k), 0, last)
            right = np.clip(j[part, None] + way * (n[part, None] + k), 0, last)
            same = (code[left] == code[right]) & (k < (room[part] - n[part])[:, None])
            found = np.where(same.all(axis=1), step, same.argmin(axis=1))
            n[part] += found
            still.append(part[found == step])
        active, step = np.concatenate(still), min(2 * step, _STEP)
    return n


def _runs(code: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs of two periods and more in the texts code[begins:ends], by start and period."""
    runs = np.empty((0, 3), np.int64)
    squares = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * code % _P, dtype=np.uint64)])
    size = 1
    while True:
        # blocks that leave room for their nearest occurrence, in texts that may hold two periods
        blocks = np.where(ends - begins >= 2 * (2 * size - 1), np.maximum((ends - begins - (2 * size - 1)) // size, 0), 0)
        if not blocks.any():
            break
        text = np.repeat(np.arange(len(begins)), blocks)
        number = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin, end = begins[text] + number * size, ends[text]
        # how far a known run of a small period reaches that begins here or before
        small = runs[runs[:, 2] <= size]
        small = small[np.argsort(small[:, 0], kind="stable")]
        reaches = np.maximum.accumulate(np.concatenate([[-1], small[:, 1]]))
        reach = reaches[np.searchsorted(small[:, 0], begin, "right")]
        seeds = []
        for at in range(0, len(begin), max(1, _CELLS // (4 * size))):
            part = slice(at, at + max(1, _CELLS // (4 * size)))
            place, distance = _occurrences(code, squares, begin[part], end[part], size)
            place = place + at
            open_ = (begin[place] + distance + size > reach[place]) & (2 * distance <= (ends - begins)[text[place]])
            seeds.append(np.stack([place[open_], distance[open_]], axis=1))
        place, distance = np.concatenate(seeds).T
        same = _equal(code, begin[place], begin[place] + distance, np.full(len(place), size), 1) == size
        place, distance = place[same], distance[same]
        # a neighbouring block with the same distance extends to the same run
        order = np.lexsort((place, distance))
        place, distance = place[order], distance[order]
        follows = np.zeros(len(place), bool)
        follows[1:] = (np.diff(place) == 1) & (np.diff(distance) == 0) & (np.diff(text[place]) == 0)
        place, distance = place[~follows], distance[~follows]
        i, limit, first = begin[place], end[place], begins[text[place]]
        right = i + size + _equal(code, i + size, i + size + distance, limit - distance - i - size, 1)
        left = i - _equal(code, i - 1, i - 1 + distance, i - first, -1)
        found = np.stack([left, right + distance, distance], axis=1)
        runs = np.concatenate([runs, found[found[:, 1] - left >= 2 * distance]])
        # of equal stretches the smallest period counts
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        again = np.zeros(len(runs), bool)
        again[1:] = (np.diff(runs[:, 0]) == 0) & (np.diff(runs[:, 1]) == 0)
        runs = runs[~again]
        size *= 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def find_runs(texts: list[list[str]]) -> list[np.ndarray]:
    """Per text, given as words, its runs of ``LEAST`` words and more as rows (start, length, period)."""
    known: dict[str, int] = {}
    code = np.fromiter((known.setdefault(w, len(known) + 1) for words in texts for w in words), np.uint64)
    sizes = np.array([len(words) for words in texts], np.int64)
    ends = np.cumsum(sizes)
    runs = _runs(code, ends - sizes, ends)
    runs = runs[runs[:, 1] - runs[:, 0] >= LEAST]
    bounds = np.searchsorted(runs[:, 0], ends)
    out = []
    for own, begin in zip(np.split(runs, bounds[:-1]), ends - sizes, strict=True):
        out.append(np.stack([own[:, 0] - begin, own[:, 1] - own[:, 0], own[:, 2]], axis=1))
    return out


def collapsed(words: list[str], runs: np.ndarray) -> str:
    """The words without those that any run holds after its first period."""
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(edges[:-1]) == 0
    return " ".join([w for w, k in zip(words, keep, strict=True) if k])


_FOUND = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([
    ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found(ids: list, texts: list[list[str]]) -> pa.RecordBatch:
        runs = find_runs(texts)
        flat = np.concatenate(runs)
        rows = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], names=["start", "length", "period"])
        at = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(at, rows),
             pa.array([collapsed(w, r) for w, r in zip(texts, runs, strict=True)], pa.string())], schema=_FOUND)

    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(doc_id)
            texts.append(_WORDS.findall(text.as_py()))
            size += len(texts[-1])
            if size >= _BATCH_WORDS:
                yield found(ids, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield found(ids, texts)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``runs``, by start and period, and ``collapsed``: the words that no run repeats."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), no_null(F.col("text")).alias("text")).mapInArrow(
        _search, "doc_id bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def longest(runs: Column) -> Column:
    """(length, -start, -period) of the longest run; of several the first, then the one of the smallest period. NULL without runs."""
    return F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with made periods: of ids whose checksum is divisible by ten, words from a place on repeat a stretch."""
    words = F.filter(F.split(no_null(F.col("text")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = F.pmod(g, F.col("n"))
    p = 1 + F.floor((F.col("n") - a) / (3 + F.pmod(g, F.lit(8))))
    at = lambda i: F.when(i >= F.col("a"), F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).otherwise(i)
    repeated = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", at(i).cast("int")))
    counted = docs.select("doc_id", "text", words.alias("words")).withColumn("n", F.size("words").cast("long"))
    placed = counted.withColumn("changed", (F.pmod(h, F.lit(10)) == 0) & (F.col("n") > 0))
    placed = placed.withColumn("a", F.when(F.col("changed"), a)).withColumn("p", F.when(F.col("changed"), p.cast("long")))
    return placed.select("doc_id", F.when(F.col("changed"), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, with their digests."""
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("top", longest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.shorter")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.shorter")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
