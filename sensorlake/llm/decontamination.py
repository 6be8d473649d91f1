"""Benchmark passages in documents, found with a positional inverted index that is partitioned by document.

The index is a stored table. Each row is the index of one block of whole
documents: every word's posting list of positions in that block. Blocks are
built where the documents are read, so building needs no shuffle, a frequent
word is spread over all blocks, and a lost task rebuilds its own blocks only.
A search takes the test phrases through every block. In a block it starts from
the phrase's rarest term, shifts that term's list by the term's offset and
intersects it with the other terms' shifted lists, the next rarest first. With
``slop`` 0 what remains is exact; a larger slop also gives proximity matches,
whose terms may each be off their place by that many words.

Defined cases: NULL text has no words; rows are judged one by one, so repeated
and NULL ids are fine; items without words match nothing; an empty table of
documents gives no rows, an empty benchmark no hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, stored, table

WINDOW = 13
_GAP = 64  # between two documents of a block, so that no phrase runs across
_BLOCK_WORDS = 400_000
_QUERY_BYTES = 8 << 20
# lower-case A-Z; what is neither 0-9, a-z nor beyond ASCII separates words
_FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256))
_INDEX_SCHEMA = ("block bigint, doc_ids array<bigint>, starts array<int>, lengths array<int>, "
                 "terms array<bigint>, ends array<int>, positions array<int>")
# A row group for each block, so that a task holds one block at a time. Else Parquet looks at the size of a row group from its
# 100th row on only, and Spark reads 4,096 rows of arrays at once: a task then holds the index of its whole share of the input.
# Almost no value of a list comes twice, so dictionaries would only cost time and memory.
_INDEX_OPTIONS = {"parquet.block.row.count.limit": "1", "parquet.enable.dictionary": "false"}
_HIT_SCHEMA = ("block bigint, place bigint, doc_id bigint, n_words bigint, hit_words array<int>, "
               "item_ids array<bigint>, n_near bigint")


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def _term(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


class _Block:
    """The index of some documents while it is built."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.docs: list[tuple[int | None, int, int]] = []
        self.codes: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, found: list[bytes]) -> None:
        codes = self.codes
        self.docs.append((doc_id, self.size, len(found)))
        if found:
            self.parts.append(np.fromiter((codes.setdefault(w, len(codes)) for w in found), np.int32, len(found)))
            self.places.append(np.arange(self.size, self.size + len(found), dtype=np.int32))
        self.size += len(found) + _GAP

    def row(self) -> dict:
        code = np.concatenate(self.parts) if self.parts else np.empty(0, np.int32)
        place = np.concatenate(self.places) if self.places else np.empty(0, np.int32)
        terms = np.fromiter(map(_term, self.codes), np.int64, len(self.codes))
        by_term = np.argsort(terms)
        rank = np.empty(len(terms), np.int32)
        rank[by_term] = np.arange(len(terms), dtype=np.int32)
        code = rank[code] if len(code) else code
        order = np.argsort(code, kind="stable")
        return {
            "block": self.number, "doc_ids": [d[0] for d in self.docs], "starts": [d[1] for d in self.docs],
            "lengths": [d[2] for d in self.docs], "terms": terms[by_term],
            "ends": np.cumsum(np.bincount(code, minlength=len(terms)), dtype=np.int32), "positions": place[order]}


def _arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


_INDEX_ARROW = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32())),
    ("terms", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())), ("positions", pa.list_(pa.int32()))])
_HIT_ARROW = pa.schema([
    ("block", pa.int64()), ("place", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("hit_words", pa.list_(pa.int32())), ("item_ids", pa.list_(pa.int64())), ("n_near", pa.int64())])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = _Block(TaskContext.get().partitionId() << 32)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            block.add(doc_id, words(text.as_py()))
            if block.size >= _BLOCK_WORDS:
                yield _arrow([block.row()], _INDEX_ARROW)
                block = _Block(block.number + 1)
    if block.docs:
        yield _arrow([block.row()], _INDEX_ARROW)


def build_index(docs: DataFrame) -> DataFrame:
    """The positional index of all words of (doc_id, text), stored in the shared folder."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(slim.mapInArrow(_build, _INDEX_SCHEMA), "positional-index", **_INDEX_OPTIONS)


class _Phrases:
    """Distinct test windows as stretches of the items' words, which lie one after another, with the items that hold them.

    All in flat arrays: some 40 bytes a word, three times that while they are made.
    """

    def __init__(self, items: list[tuple[int, str | None]], window: int) -> None:
        found = [np.fromiter(map(_term, own), np.int64, len(own)) for own in (words(text) for _, text in items)]
        n_words = np.array([len(own) for own in found], np.int64)
        self.hashes, codes = np.unique(np.concatenate([np.empty(0, np.int64), *found]), return_inverse=True)
        # items shorter than a window are filled up with a number that is no term's
        n_places = np.where(n_words, np.maximum(n_words, window), 0)
        begins = np.cumsum(n_places) - n_places
        self.words = np.full(int(n_places.sum()), len(self.hashes), np.int32)
        self.words[_within(begins, n_words)] = codes
        n_windows = np.where(n_words, n_places - window + 1, 0)
        starts, item = _within(begins, n_windows), np.repeat(np.arange(len(items)), n_windows)
        _, first, number = np.unique(_classes(self.words, window)[starts], return_index=True, return_inverse=True)
        self.starts, self.lengths = starts[first], np.minimum(n_words[item[first]], window)
        # of each window, its items in ascending order, without those that have no id
        ids = np.array([0 if i is None else i for i, _ in items], np.int64)[item]
        named = np.flatnonzero(np.array([i is not None for i, _ in items], bool)[item])
        order = named[np.lexsort((ids[named], number[named]))]
        ids, number = ids[order], number[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (ids[1:] != ids[:-1]) | (number[1:] != number[:-1])
        self.items, self.ends = ids[fresh], np.cumsum(np.bincount(number[fresh], minlength=len(first)))

    def items_of(self, w: int) -> list[int]:
        return self.items[self.ends[w - 1] if w else 0:self.ends[w]].tolist()


def _within(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each beginning on, as many as its count."""
    return np.repeat(begins - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _classes(codes: np.ndarray, width: int) -> np.ndarray:
    """For every place a number that places share just if the ``width`` codes from there on are equal."""
    found, span = codes.astype(np.int64), 1
    while span < width and len(found):
        step = min(span, width - span)
        found = np.unique(found[:-step] * (found.max() + 1) + found[step:], return_inverse=True)[1]
        span += step
    return found


def _matches(lists: list[np.ndarray], offsets: np.ndarray, slop: int) -> np.ndarray:
    """Start positions at which every list has an entry at its offset, give or take ``slop``.

    ``lists`` come rarest first; the first fixes the candidates.
    """
    found = lists[0] - offsets[0]
    for positions, offset in zip(lists[1:], offsets[1:], strict=True):
        if not len(found):
            break
        wanted = found + offset
        first = np.searchsorted(positions, wanted - slop)
        found = found[np.searchsorted(positions, wanted + slop, side="right") > first]
    return found


def _search_block(row: dict, phrases: _Phrases, slop: int) -> list[dict]:
    starts, lengths = np.asarray(row["starts"], np.int64), np.asarray(row["lengths"], np.int64)
    terms, ends, positions = row["terms"], row["ends"], row["positions"]
    n_docs = len(starts)
    items: list[set[int]] = [set() for _ in range(n_docs)]
    near = np.zeros(n_docs, np.int64)
    covered = np.zeros(int(starts[-1] + lengths[-1]) + _GAP + 1 if n_docs else 1, np.int32)
    if len(terms) and len(phrases.hashes):
        at = np.minimum(np.searchsorted(terms, phrases.hashes), len(terms) - 1)
        known = terms[at] == phrases.hashes
        begins = np.concatenate([[0], ends[:-1]])
        sizes = np.where(known, ends[at] - begins[at], 0)  # list lengths of the test terms
        # words without a list, up to each place; what fills up short items is none
        absent = np.concatenate([[0], np.cumsum(np.append(sizes == 0, False)[phrases.words])])
        for w in np.flatnonzero(absent[phrases.starts] == absent[phrases.starts + phrases.lengths]):
            window = phrases.words[phrases.starts[w]:phrases.starts[w] + phrases.lengths[w]]
            order = np.argsort(sizes[window], kind="stable")
            lists = [positions[begins[at[t]]:ends[at[t]]] for t in window[order]]
            if slop:
                close = _matches(lists, order, slop)
                near += np.bincount(np.searchsorted(starts, close + order[0], side="right") - 1, minlength=n_docs)
            exact = _matches(lists, order, 0)
            if len(exact):
                covered[exact] += 1
                covered[exact + len(window)] -= 1
                for d in np.unique(np.searchsorted(starts, exact, side="right") - 1):
                    items[d].update(phrases.items_of(w))
    hit = np.flatnonzero(np.cumsum(covered) > 0)
    first, last = np.searchsorted(hit, starts), np.searchsorted(hit, starts + lengths)
    return [{"block": row["block"], "place": d, "doc_id": row["doc_ids"][d], "n_words": int(lengths[d]),
             "hit_words": hit[first[d]:last[d]] - starts[d], "item_ids": sorted(items[d]), "n_near": int(near[d])}
            for d in range(n_docs)]


def _blocks(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        row = {name: batch.column(name)[i].values for name in ("starts", "lengths", "terms", "ends", "positions")}
        yield {k: v.to_numpy(zero_copy_only=False) for k, v in row.items()} | {
            name: batch.column(name)[i].as_py() for name in ("block", "doc_ids")}


def search(index: DataFrame, items: list[tuple[int, str | None]], window: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row per document: its place in the index, number of words, the words (by position) inside
    occurrences of test windows, the items found, and with ``slop`` the number of proximity matches,
    exact ones included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = _Phrases(items, window)
        for batch in batches:
            for row in _blocks(batch):
                yield _arrow(_search_block(row, phrases, slop), _HIT_ARROW)

    return index.mapInArrow(run, _HIT_SCHEMA)


def query_blocks(benchmark: DataFrame, block_bytes: int = _QUERY_BYTES) -> Iterator[list[tuple[int, str | None]]]:
    """The stated test items in blocks of about ``block_bytes``, so that a benchmark of any size can be searched for."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        if block and size + len(row.text or "") > block_bytes:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += len(row.text or "")
    yield block


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = _QUERY_BYTES) -> DataFrame:
    """Per document n_words, n_hit and item_ids. The index is built once and read once per block of test items."""
    index = build_index(docs)
    blocks = query_blocks(benchmark, block_bytes)
    found, following = search(index, next(blocks), window), next(blocks, None)
    if following is not None:
        found = stored(found, "hits")
        while following is not None:
            found = found.unionByName(stored(search(index, following, window), "hits"))
            following = next(blocks, None)
        found = found.groupBy("block", "place", "doc_id", "n_words").agg(
            F.array_distinct(F.flatten(F.collect_list("hit_words"))).alias("hit_words"),
            F.array_distinct(F.flatten(F.collect_list("item_ids"))).alias("item_ids"))
    return found.select("doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), "item_ids")


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words lies inside test windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark's 13-word windows."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))
