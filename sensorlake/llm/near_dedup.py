"""MinHash near-duplicates with circulant permutations, banding and exact verification.

A document is the set of its distinct five-word shingles. One permutation,
sigma, sends every shingle to one of 2^32 places; a second one, pi, gives every
place a rank. Coordinate k of the signature is the least rank among the places
shifted by k around the circle, so two permutations stand for all coordinates.
Both are computed on the way, so there are as many places as ranks, and a set of
millions of shingles still leaves nearly all of them free.

Bands of the signature name buckets. Documents with equal sets are one class
from the start, named by 64 bits of the set's hash. In a bucket every class is
paired with the smallest one only; pairs are verified on the full sets and
joined to components. A bucket that then still holds several components is
settled pair by pair across them, see ``_across``. So no pairs within a group of
copies are listed, and no link between documents that share a bucket is lost.

Defined cases: NULL and empty texts have an empty set, are linked with nothing
and kept; rows with the same id and text are one document and returned as often
as they come in; different texts of one id are documents of their own, whose
links are not mixed; a NULL id is linked with nothing; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import no_null, small_batches, stored, table

SHINGLE = 5
SIMILAR = 85  # per cent
BANDS, ROWS = 32, 7  # a pair shares a bucket with probability 1 - 4e-6 at similarity 0.85, 0.9995 at 0.8
_BLOCK = 100_000  # shingles of a crowded bucket's members that are compared in one go with as many others
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_KNOWN_WORDS = 150_000
_BATCH_CHARS = 1_000_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_known: dict[bytes, int] = {}


def _codes(words: list[list[bytes]]) -> np.ndarray:
    """64-bit hashes of all words, one text after the other."""
    distinct = set().union(*words)
    new = distinct - _known.keys()
    if len(_known) + len(new) > _KNOWN_WORDS:
        _known.clear()
        new = distinct
    _known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
    return np.fromiter(map(_known.__getitem__, chain.from_iterable(words)), np.uint64)


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text as 64-bit hashes."""
    words = [t.encode().translate(_FOLD).split() if t else [] for t in texts]
    code = _codes(words)
    turn = np.uint64(0x9E3779B97F4A7C15)
    whole = np.full(max(len(code) - SHINGLE + 1, 0), SHINGLE, np.uint64)
    for i in range(SHINGLE if len(whole) else 0):
        whole = _mixed(whole * turn + code[i:len(code) - SHINGLE + 1 + i])
    at = 0
    for found in words:
        n = len(found)
        if n >= SHINGLE:
            own = np.sort(whole[at:at + n - SHINGLE + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n:
            own = np.full(1, n, np.uint64)
            for c in code[at:at + n]:
                own = _mixed(own * turn + c)
            yield own
        else:
            yield np.empty(0, np.uint64)
        at += n


def _ranks(places: np.ndarray) -> np.ndarray:
    """pi: a bijection of 32-bit numbers that spreads every bit; overwrites ``places``."""
    places ^= places >> np.uint32(16)
    places *= np.uint32(0x7FEB352D)
    places ^= places >> np.uint32(15)
    places *= np.uint32(0x846CA68B)
    places ^= places >> np.uint32(16)
    return places


_SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint32)


def signature(found: np.ndarray, seed: int = 42) -> np.ndarray:
    sigma = (_mixed(found ^ np.uint64(0xA0761D6478BD642F + seed)) >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(sigma), 128):
        np.minimum(least, _ranks(sigma[at:at + 128, None] + _SHIFTS).min(axis=0), out=least)
    return least


def bands(found: np.ndarray) -> np.ndarray:
    rows = signature(found).reshape(BANDS, ROWS)
    return np.array([xxhash.xxh3_64_intdigest(r.tobytes(), b) for b, r in enumerate(rows)], np.uint64).view(np.int64)


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """Row keys, ids and texts, about a million characters at a time."""
    rows, ids, texts, size = [], [], [], 0
    for batch in batches:
        for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            rows.append(row)
            ids.append(doc_id)
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size >= _BATCH_CHARS:
                yield rows, ids, texts
                rows, ids, texts, size = [], [], [], 0
    if rows:
        yield rows, ids, texts
    _known.clear()
    pa.default_memory_pool().release_unused()


def _node(found: np.ndarray) -> int:
    """The name of a class of equal sets."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, ids, texts in _batched(batches):
        found = list(shingle_sets(texts))
        linked = [len(f) > 0 and i is not None for i, f in zip(ids, found, strict=True)]
        yield pa.RecordBatch.from_arrays([
            pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array([len(f) for f in found], pa.int64()),
            pa.array([_node(f) if on else None for f, on in zip(found, linked, strict=True)], pa.int64()),
            pa.array([bands(f) if on else None for f, on in zip(found, linked, strict=True)], pa.list_(pa.int64()))],
            names=["row", "doc_id", "n_shingles", "node", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, texts in _batched(batches):
        found = list(shingle_sets(texts))
        yield pa.RecordBatch.from_arrays(
            [pa.array([_node(f) for f in found], pa.int64()), pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))],
            names=["node", "found"])


def _verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    left = sets.withColumnsRenamed({"node": "a", "found": "in_a"}).hint("merge")
    right = sets.withColumnsRenamed({"node": "b", "found": "in_b"}).hint("merge")
    both = F.size(F.array_intersect("in_a", "in_b"))
    union = F.size("in_a") + F.size("in_b") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= similar * union).select("a", "b")


def _compare(group: pa.Table, similar: int) -> pa.Table:
    """Links from the seekers in a group to its members of other components, from postings of their shingles."""
    node, component = group.column("node").to_numpy(), group.column("component").to_numpy()
    found = [f.values.to_numpy() for f in group.column("found").combine_chunks()]
    seeks = group.column("seeks").to_numpy(zero_copy_only=False)
    size = np.array([len(f) for f in found])
    member = np.repeat(np.arange(len(found)), size)
    _, code = np.unique(np.concatenate(found), return_inverse=True)
    order = np.argsort(code, kind="stable")
    begins = np.concatenate([[0], np.cumsum(np.bincount(code))])
    holders, ends = member[order], np.cumsum(size)
    a, b = [], []
    for x in np.flatnonzero(seeks):
        own = code[ends[x] - size[x]:ends[x]]
        lengths = begins[own + 1] - begins[own]
        at = np.repeat(begins[own] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        both = np.bincount(holders[at], minlength=len(found))
        linked = (100 * both >= similar * (size[x] + size - both)) & (component != component[x]) & ~seeks
        for y in np.flatnonzero(linked):
            a.append(node[x])
            b.append(node[y])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def dealt_members(members: DataFrame) -> DataFrame:
    """Groups (key, i, j) of seekers and the members that they are compared with, of buckets (key, node, component, n_shingles).

    Seekers are the members outside their bucket's largest component. They are
    dealt into blocks i and all members into blocks j, of about ``_BLOCK``
    shingles each, and each two blocks meet in a group. So a group is bounded
    however large its bucket is, and members of the largest component are never
    dealt to one another: rows grow with the members times the blocks of seekers.
    """
    counted = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = counted.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("most"), F.count("*").alias("parts"))
    crowded = stored(members.join(largest.where("parts > 1").select("key", "most"), "key").withColumn(
        "seeks", F.col("component") != F.col("most")), "crowded")
    blocks = lambda size: F.ceil(F.sum(size) / _BLOCK).cast("int")
    sizes = crowded.groupBy("key").agg(
        blocks(F.when(F.col("seeks"), F.col("n_shingles"))).alias("seekers"), blocks("n_shingles").alias("others"))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    placed = crowded.join(sizes, "key")
    seekers = placed.where("seeks").select("key", own("seekers").alias("i"), every("others").alias("j"), "node", "component", "seeks")
    others = placed.select(
        "key", every("seekers").alias("i"), own("others").alias("j"), "node", "component", F.lit(False).alias("seeks"))
    return seekers.unionByName(others)


def _across(members: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Links between different components in a bucket (key, node, component, n_shingles)."""
    return dealt_members(members).join(sets.hint("merge"), "node").groupBy("key", "i", "j").applyInArrow(
        lambda group: _compare(group, similar), "a bigint, b bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest reachable node for every node of (a, b), by alternating large and small stars.

    Each round links a node's larger neighbours, then its smaller ones, to the
    least of them; rounds grow with the logarithm of the longest chain.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = stored(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("least").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("least").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = stored(small.where("u <> v").distinct(), "links")


def row_key() -> Column:
    """64 bits that rows with the same id and text share."""
    return F.xxhash64("doc_id", no_null(F.col("text")))


def near_rows(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its ``row_key`` as row, doc_id, n_shingles, and of its component
    the smallest doc_id, component_id, and the row of it, first_row; for a row without links its own."""
    small_batches(docs.sparkSession)
    slim = docs.select(row_key().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = stored(
        slim.mapInArrow(_mark, "row bigint, doc_id bigint, n_shingles bigint, node bigint, bands array<bigint>"), "marks")
    # one row of each class stands for it, one with its smallest id
    classes = stored(marks.where("node IS NOT NULL").groupBy("node", "n_shingles").agg(
        F.min("doc_id").alias("first_id"), F.min_by("row", "doc_id").alias("row")), "classes")
    first = marks.join(classes.select("node", "row"), ["node", "row"]).select("node", "n_shingles", F.explode("bands").alias("key"))
    leaders = first.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last")
    crowded = stored(first.join(leaders.select("key", "leader"), "key").distinct(), "buckets")
    wanted = classes.join(crowded.select("node").distinct(), "node").select("row")
    # texts are dealt by their rows at every size; rows that are repeated come together and one of them is taken
    texts = slim.join(wanted.hint("merge"), "row", "left_semi").dropDuplicates(["row"])
    sets = stored(texts.mapInArrow(_sets, "node bigint, found array<bigint>"), "sets")
    stars = crowded.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(_verified(stars, sets, similar), "links")
    found = components(links)
    # pairs with the leader are settled; what else shares a bucket and is not yet in one component is compared
    rest = crowded.where("node <> leader").select("key", "node", "n_shingles").join(found, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component"), "n_shingles")
    found = components(links.unionByName(_across(rest, sets, similar)))
    named = classes.join(found, "node", "left").select("node", "first_id", "row", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"), F.min_by("row", "first_id").alias("first_row"))
    named = stored(named.select("node", "component").join(smallest, "component").drop("component"), "named")
    return marks.drop("bands").join(named, "node", "left").select(
        "row", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("first_row", "row").alias("first_row"))


def near_duplicates(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_shingles, component_id, kept, from ``similar`` per cent on."""
    return near_rows(docs, similar).select(
        "doc_id", "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under similarity of at least 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"))
