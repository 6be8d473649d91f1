"""Repeated passages across documents, from a sparse suffix array over all documents.

A suffix may begin where its first 50 words are a window whose minimiser is kept.
The minimiser of a window is the position among its first 20 where the hash of
the next 31 words is the least; the choice depends on the content alone, so
copies of a window have the same minimiser. Minimisers whose 31 words occur in
one document only are dropped before anything but hashes has moved. For each of
the others the up to 20 suffixes that begin left of it, and have it as their
minimiser, are retained: every pair of equal windows of two documents is among
them, wherever else the documents agree or differ.

The suffixes of all documents are sorted together, in ranges, by their first 50
words (in the order of the words' hash), then by document and place. Suffixes
with equal first words stand next to each other, so neighbours of different
documents show a repeated window, and one pass over the sorted suffixes finds a
partner for each. A run of equal suffixes may stretch over many ranges: each
range passes on the documents of its first and last run only, by which the
suffixes there are settled. Matches whose suffixes begin side by side, or
overlap, are extended to the left and right into whole passages.

No pairs are listed: a group of n copies is a run of n neighbours, and a hot run
fills several ranges.

Words are compared as 64-bit hashes, first words of suffixes as 64-bit hashes of
those. Among n different windows about n * n / 2^65 pairs have equal hashes by
chance; reported passages are not compared word by word once more.

Defined cases: words stand between ASCII white space and are compared as they
are; NULL and short texts have no passages; rows without an id are left out and
rows with the same id count as one document; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

MIN_WORDS = 50
WINDOW = 20
PREFIX = MIN_WORDS - WINDOW + 1
_TURN = 0x9E3779B97F4A7C15
_BACK = pow(_TURN, -1, 1 << 64)
_KNOWN_WORDS = 150_000
_BATCH_CHARS = 1_000_000
_known: dict[bytes, int] = {}


def _codes(texts: list[str | None]) -> list[np.ndarray]:
    """The words of each text as 64-bit hashes."""
    words = [t.encode().split() if t else [] for t in texts]
    distinct = set().union(*words)
    new = distinct - _known.keys()
    if len(_known) + len(new) > _KNOWN_WORDS:
        _known.clear()
        new = distinct
    _known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
    flat = np.fromiter(map(_known.__getitem__, chain.from_iterable(words)), np.uint64)
    return np.split(flat, np.cumsum([len(w) for w in words])[:-1])


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


def prefix_hashes(code: np.ndarray, width: int = PREFIX) -> np.ndarray:
    """The hash of the ``width`` words from every position on, by differences of a running sum."""
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * _powers(_TURN, len(code))[:-1], dtype=np.uint64)])
    # the sum from i on has the factor turn^i, which its inverse modulo 2^64 takes out
    found = (upto[width:] - upto[:-width]) * _powers(_BACK, len(code) - width)
    found = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


def minimisers(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose prefix hash is the least of some window, and these hashes."""
    if len(code) < MIN_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    found = prefix_hashes(code)
    least = _sliding(found, WINDOW, np.minimum)
    margin = np.zeros(WINDOW - 1, np.uint64)
    best = _sliding(np.concatenate([margin, least, margin]), WINDOW, np.maximum)
    at = np.flatnonzero(best == found)
    return at, found[at]


def _batched(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[list[list], list[np.ndarray]]]:
    """Rows without their text, and the words of the texts, about a million characters at a time."""
    rows, texts, size = [], [], 0
    for batch in batches:
        others = [batch.column(i).to_pylist() for i in range(batch.num_columns) if i != text_at]
        for *row, text in zip(*others, batch.column(text_at), strict=True):
            rows.append(row)
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size >= _BATCH_CHARS:
                yield rows, _codes(texts)
                rows, texts, size = [], [], 0
    if rows:
        yield rows, _codes(texts)
    _known.clear()


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The minimisers of each text; ``first`` marks one of each key in a text."""
    for rows, codes in _batched(batches, 1):
        found = [minimisers(c) for c in codes]
        keys = np.concatenate([k for _, k in found])
        row = np.repeat(np.arange(len(rows)), [len(k) for _, k in found])
        order = np.lexsort((keys, row))
        first = np.ones(len(keys), bool)
        first[order[1:]] = (np.diff(row[order]) != 0) | (keys[order[1:]] != keys[order[:-1]])
        yield pa.RecordBatch.from_arrays([
            pa.array(keys.view(np.int64)), pa.array(np.array([r[0] for r in rows], np.int64)[row]),
            pa.array(np.concatenate([p for p, _ in found]).astype(np.int32)), pa.array(first)],
            names=["key", "doc_id", "pos", "first"])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes of each text whose first window has one of the given positions as its minimiser."""
    for rows, codes in _batched(batches, 2):
        windows, docs, starts = [], [], []
        for (doc_id, positions), code in zip(rows, codes, strict=True):
            if len(code) < MIN_WORDS:
                continue
            found = prefix_hashes(code)
            at = np.array(positions)
            # another row with this id may be longer
            wanted = found[at[at < len(found)]]
            own = np.flatnonzero(np.isin(_sliding(found, WINDOW, np.minimum), wanted))
            windows.append(prefix_hashes(code, MIN_WORDS)[own].view(np.int64))
            docs.append(np.full(len(own), doc_id, np.int64))
            starts.append(own.astype(np.int32))
        if windows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (windows, docs, starts)], names=["words", "doc_id", "start_word"])


_NONE = np.iinfo(np.int64).max  # no document
_SORTED_ROWS = 1 << 16
_FOUND = ["words", "doc_id", "start_word", "other_id", "edge"]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """The columns of sorted suffixes, many rows at a time."""
    held, size = [], 0
    for batch in chain(batches, [None]):
        if batch is not None:
            held.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
        if size and (batch is None or size >= _SORTED_ROWS):
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
            held, size = [], 0


class _Run:
    """The run of equal first words that a range is in: its first document, and the next one once it is seen."""

    def __init__(self, words: int, head: bool):
        self.words, self.head, self.least, self.second = words, head, _NONE, _NONE
        self.waiting: list[np.ndarray] = []  # places in the first document, until there is a second one

    def take(self, docs: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The partners of further suffixes, which come in the order of their documents."""
        if self.least == _NONE:
            self.least = int(docs[0])
        own = int(np.searchsorted(docs, self.least, "right"))
        if own:
            self.waiting.append(starts[:own])
        if own < len(docs):
            if self.second == _NONE:
                self.second = int(docs[own])
                yield from self.release(self.second, self.head)
            yield self.rows(docs[own:], starts[own:], self.least, self.head)

    def release(self, other: int, edge: bool) -> Iterator[pa.RecordBatch]:
        if self.waiting:
            starts = np.concatenate(self.waiting)
            self.waiting = []
            yield self.rows(np.full(len(starts), self.least), starts, other, edge)

    def end(self, last: bool) -> Iterator[pa.RecordBatch]:
        """What is left when the run, or the range with it, ends: at an edge also its documents, at no place."""
        if self.head or last:
            yield from self.release(_NONE, True)
            known = np.array([d for d in (self.least, self.second) if d != _NONE])
            yield self.rows(known, np.full(len(known), -1, np.int32), _NONE, True)

    def rows(self, docs: np.ndarray, starts: np.ndarray, other: int, edge: bool) -> pa.RecordBatch:
        n = len(docs)
        return pa.RecordBatch.from_arrays(list(map(pa.array, (
            np.full(n, self.words), docs, starts, np.full(n, other), np.full(n, edge)))), names=_FOUND)


def _whole_runs(words: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """The suffixes of runs that lie inside a range and have two documents."""
    opens = np.concatenate([[True], words[1:] != words[:-1]])
    run = np.cumsum(opens) - 1
    least = docs[opens][run]
    # by document, so the first one after the least is the next in order
    turn = np.flatnonzero((docs[1:] != docs[:-1]) & ~opens[1:]) + 1
    second = np.full(opens.sum(), _NONE)
    second[run[turn[::-1]]] = docs[turn[::-1]]
    other = np.where(docs != least, least, second[run])
    out = other != _NONE
    return pa.RecordBatch.from_arrays(list(map(pa.array, (
        words[out], docs[out], starts[out], other[out], np.zeros(out.sum(), bool)))), names=_FOUND)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes of a sorted range that have a partner, with the smallest other document of their run.

    The first and the last run of a range may go on in others; what they do not
    settle comes out as ``edge``, with the run's first two documents beside it.
    """
    run = None
    for words, docs, starts in _gathered(batches):
        if run is None:
            run = _Run(int(words[0]), True)
        goes_on = int(np.searchsorted(words, run.words, "right"))
        if goes_on:
            yield from run.take(docs[:goes_on], starts[:goes_on])
        if goes_on == len(words):
            continue
        yield from run.end(False)
        last = int(np.searchsorted(words, words[-1]))
        if last > goes_on:
            yield _whole_runs(words[goes_on:last], docs[goes_on:last], starts[goes_on:last])
        run = _Run(int(words[-1]), False)
        yield from run.take(docs[last:], starts[last:])
    if run is not None:
        yield from run.end(True)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """The windows (doc_id, start_word) that another document holds too, with the smallest such document (other_id)."""
    slim = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    anchors = stored(slim.mapInArrow(_anchors, "key bigint, doc_id bigint, pos int, first boolean"), "anchors")
    # as a table, so that the join has two plain shuffles and a hot key of the other side can be split
    keys = stored(anchors.groupBy("key").agg(F.count_if("first").alias("n")).where("n > 1").select("key"), "keys")
    wanted = stored(anchors.join(keys, "key", "left_semi").groupBy("doc_id").agg(
        F.sort_array(F.collect_set("pos")).alias("positions")), "kept")
    suffixes = stored(wanted.join(slim, "doc_id").select("doc_id", "positions", "text").mapInArrow(
        _suffixes, "words bigint, doc_id bigint, start_word int"), "suffixes")
    order = ["words", "doc_id", "start_word"]
    # written, since the ranges are cut by a sample
    found = stored(suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _neighbours, "words bigint, doc_id bigint, start_word int, other_id bigint, edge boolean"), "neighbours")
    # four documents a range at most
    ends = found.where("start_word < 0").groupBy("words").agg(F.sort_array(F.collect_set("doc_id")).alias("docs"))
    ends = ends.select("words", F.get("docs", F.lit(0)).alias("least"), F.get("docs", F.lit(1)).alias("second"))
    other = F.when(F.col("doc_id") != F.col("least"), F.col("least")).otherwise(F.col("second"))
    settled = found.where("start_word >= 0").join(F.broadcast(ends), "words", "left").select(
        "doc_id", "start_word", F.when(F.col("edge"), other).otherwise(F.col("other_id")).alias("other_id"))
    return settled.where("other_id IS NOT NULL")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """The passages of every document that occur in others, whole or piece by piece: matches extended to both sides.

    ``other_id`` is the smallest id among the other documents that hold a window of the passage.
    """
    place = Window.partitionBy("doc_id").orderBy("start_word")
    gap = F.col("start_word") - F.lag("start_word").over(place)
    opens = repeated_windows(docs).withColumn("opens", F.when(gap <= MIN_WORDS, 0).otherwise(1))
    return opens.withColumn("passage", F.sum("opens").over(place.rowsBetween(Window.unboundedPreceding, 0))).groupBy(
        "doc_id", "passage").agg(
        F.min("start_word").cast("long").alias("start_word"), (F.max("start_word") + MIN_WORDS).cast("long").alias("end_word"),
        F.min("other_id").alias("other_id"),
    ).select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "other_id")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 and more words that documents share."""
    return repeated_passages(table(spark, sf_dir, "documents"))
