"""Hard negatives for contrastive training, from candidate blocks along a Hilbert curve.

Vectors of whole numbers are sorted along a Hilbert curve and written as blocks
of ``BLOCK`` rows, one Parquet row a block, with the least and the greatest
value per dimension (zone map). For an anchor a, interval arithmetic bounds the
score of every row of a block: the sum over the dimensions of the greater (or
lesser) of a_i * lo_i and a_i * hi_i. Two passes use the bounds:

1. positives: blocks that hold the anchor's label and may beat the fifth best
   score that the anchor found in its own block;
2. negatives: blocks with another label whose bounds meet a window
   [0.8 p, p] of one of the anchor's positive scores p.

Each pass first compares anchors with zone maps only, then sends an anchor to
the groups of blocks it must read; blocks that nobody needs are not read. Inside
a group the bounds choose again, block by block. Anchors and groups meet in
cells of bounded size, and each cell returns five rows an anchor and window.

Defined cases: a row with a NULL label or vector, or with a NULL or non-finite
component, takes no part; a NULL id is an id like others, comes last in ties, is
no anchor and is returned as NULL; rows equal in id, label and vector count
once; rows of one id are never each other's positives or negatives; of rows
with one id and other vectors or labels each is an anchor and a candidate; a
shorter vector counts as filled up with zeros, so an empty one scores 0 with
all; an anchor without positives, or with windows that hold no row, has no
rows; an empty table gives none; other columns are ignored. Scores are exact,
with numbers of any size inside, and an error where one does not fit a BIGINT.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, stored, table

FIRST = 5  # positives an anchor, negatives a positive
LOWEST = 80  # per cent of the positive score that a negative must reach
SCALE = 256
BLOCK = 256  # rows a block
GROUP = 64  # blocks that are read together
ZONES = 4096  # zone maps, and
ANCHORS = 4096  # anchors, that meet in one cell
_BITS = 4  # a dimension along the curve
_NO_ID = np.iinfo(np.int64).max
_EXACT = float(1 << 53)
_PIECE = 512  # anchors multiplied with a block at once


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Position along the Hilbert curve of every row of whole numbers in [0, 2^bits), as sortable bytes."""
    x = cells.astype(np.uint32).T.copy()
    if not x.size:
        return [b""] * len(cells)
    low = [np.uint32((1 << b) - 1) for b in range(bits)]
    for b in range(bits - 1, 0, -1):
        for axis in x:
            turned = ((axis >> np.uint32(b)) & np.uint32(1)).astype(bool)
            swapped = np.where(turned, 0, (x[0] ^ axis) & low[b]).astype(np.uint32)
            x[0] ^= np.where(turned, low[b], swapped).astype(np.uint32)
            axis ^= swapped
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint32(b)) & np.uint32(1), low[b], 0).astype(np.uint32)
    x ^= turn
    # bit b of all axes, then bit b - 1 of all axes, ...
    planes = np.stack([(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)])
    packed = np.packbits(planes.reshape(-1, x.shape[1]).astype(np.uint8), axis=0).T
    return [row.tobytes() for row in np.ascontiguousarray(packed)]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows; beyond what doubles hold exactly, in numbers of any size."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= _EXACT:
        return np.array([[int(v) for v in row] for row in a], object) @ np.array([[int(v) for v in row] for row in b], object).T
    return a @ b.T


def _matrix(rows: pa.ChunkedArray, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows.to_pylist()), np.float64).reshape(-1, dims)


def _bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per anchor and block the least and greatest possible score, widened by what doubles may lose."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    least, most = up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T
    loss = (np.abs(anchors) @ np.maximum(np.abs(lo), np.abs(hi)).T) * (4e-16 * (anchors.shape[1] + 1))
    return least - loss, most + loss


def _best(who: np.ndarray, score: np.ndarray, row_id: np.ndarray) -> np.ndarray:
    """Places of the first rows of each of ``who``, by score and then id."""
    order = np.lexsort((row_id, -score, who))
    who = who[order]
    begins = np.concatenate([[True], who[1:] != who[:-1]]) if len(who) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(begins, np.arange(len(who)), 0))
    return order[np.arange(len(who)) - begin < FIRST]


class _Tops:
    """The first rows found so far for each of ``n`` seekers."""

    def __init__(self, n: int):
        self.who, self.score, self.row_id = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        self.worst = np.full(n, -np.inf)

    def add(self, who: np.ndarray, score: np.ndarray, row_id: np.ndarray) -> None:
        if not len(who):
            return
        who, score = np.concatenate([self.who, who]), np.concatenate([self.score, score])
        row_id = np.concatenate([self.row_id, row_id])
        best = _best(who, score, row_id)
        self.who, self.score, self.row_id = who[best], score[best], row_id[best]
        full = np.bincount(self.who, minlength=len(self.worst)) >= FIRST
        last = np.full(len(self.worst), np.inf)
        np.minimum.at(last, self.who, self.score.astype(np.float64))
        self.worst = np.where(full, last, -np.inf)


def _keyed(dims: int, reach: float):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = 2 * reach / (1 << _BITS)
        for batch in batches:
            lengths = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
            vectors = np.zeros((len(lengths), dims))
            vectors[np.arange(dims) < lengths[:, None]] = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            vectors = np.floor(SCALE * vectors)
            cells = np.clip(np.floor((vectors + reach) / step), 0, (1 << _BITS) - 1)
            yield pa.RecordBatch.from_arrays([
                pa.array(hilbert_keys(cells, _BITS), pa.binary()), batch.column("id"), batch.column("label"), batch.column("anchor"),
                pa.array([v.tobytes() for v in vectors], pa.binary())], names=["place", "id", "label", "anchor", "vector"])
    return keys


_BLOCKS = ("block bigint, ids array<bigint>, labels array<bigint>, vectors binary, lo binary, hi binary, least bigint, most bigint, "
           "anchors array<struct<id:bigint,label:bigint,vector:binary,worst:double>>")


def _blocked(dims: int):
    def block(number: int, rows: list[tuple]) -> pa.RecordBatch:
        # by id, so that equal scores stand in the order of ids
        rows.sort(key=lambda r: r[1])
        ids = np.array([r[1] for r in rows], np.int64)
        labels = np.array([r[2] for r in rows], np.int64)
        vectors = np.frombuffer(b"".join(r[4] for r in rows), np.float64).reshape(len(rows), dims)
        at = np.array([i for i, r in enumerate(rows) if r[3]], np.int64)
        scores, tops = _products(vectors[at], vectors), _Tops(len(at))
        who, row = np.nonzero((labels[at][:, None] == labels) & (ids[at][:, None] != ids))
        tops.add(who, scores[who, row], ids[row])
        anchors = [{"id": int(ids[i]), "label": int(labels[i]), "vector": vectors[i].tobytes(), "worst": float(w)}
                   for i, w in zip(at, tops.worst, strict=True)]
        return pa.RecordBatch.from_pylist([{
            "block": number, "ids": ids, "labels": labels, "vectors": vectors.tobytes(), "lo": vectors.min(axis=0).tobytes(),
            "hi": vectors.max(axis=0).tobytes(), "least": int(labels.min()), "most": int(labels.max()), "anchors": anchors,
        }], pa.schema([
            ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("vectors", pa.binary()),
            ("lo", pa.binary()), ("hi", pa.binary()), ("least", pa.int64()), ("most", pa.int64()),
            ("anchors", pa.list_(pa.struct([("id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()), ("worst", pa.float64())])))]))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, before = TaskContext.get().partitionId() << 32, [], None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row == before:
                    continue
                if len(rows) == BLOCK:
                    yield block(number, rows)
                    number, rows = number + 1, []
                rows.append(row)
                before = row
        if rows:
            yield block(number, rows)
    return blocks


def candidate_blocks(rows: DataFrame, is_anchor: Column) -> tuple[DataFrame, int]:
    """Blocks of ``rows`` (vec_id, embedding, label) along the Hilbert curve, written once, and the number of dimensions."""
    spark = rows.sparkSession
    small_batches(spark)
    vector = F.col("embedding").cast("array<double>")
    finite = F.coalesce(F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(SCALE * v) < float("inf"))), F.lit(False))
    slim = rows.where(F.col("label").isNotNull() & finite).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(int(_NO_ID))).alias("id"), F.col("label").cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), vector.alias("vector"))
    dims, reach = slim.agg(
        F.greatest(F.max(F.size("vector")), F.lit(1)),
        F.coalesce(F.max(F.array_max(F.transform("vector", F.abs))), F.lit(0.0)) * SCALE + 1).first()
    order = ["place", "id", "label", "vector"]
    keyed = slim.mapInArrow(
        _keyed(dims, reach), "place binary, id bigint, label bigint, anchor boolean, vector binary")
    # equal rows come together: the place, id, label and vector are all there is to order by
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order, "anchor")
    return stored(dealt.mapInArrow(_blocked(dims), _BLOCKS), "blocks"), dims


def _met(left: pa.Table, right: pa.Table, dims: int, wanted) -> pa.Table:
    """(group, anchor) for every group with a block that the anchor must read; from zone maps alone."""
    if not left.num_rows or not right.num_rows:
        return pa.table({"anchor": pa.array([], pa.int64()), "group": pa.array([], pa.int64())})
    lo, hi = _matrix(left["lo"], dims), _matrix(left["hi"], dims)
    least, most, group = (left[c].to_numpy() for c in ("least", "most", "group"))
    names, group = np.unique(group, return_inverse=True)
    anchors, groups = [], []
    for at in range(0, right.num_rows, _PIECE):
        part = right.slice(at, _PIECE)
        low, high = _bounds(_matrix(part["vector"], dims), lo, hi)
        needed = wanted(part, low, high, least, most)
        hit = np.zeros((part.num_rows, len(names)), bool)
        who, block = np.nonzero(needed)
        hit[who, group[block]] = True
        who, found = np.nonzero(hit)
        anchors.append(part["anchor"].to_numpy()[who])
        groups.append(names[found])
    return pa.table({"anchor": np.concatenate(anchors), "group": np.concatenate(groups)})


def _same_label(part: pa.Table, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    label = part["label"].to_numpy()[:, None]
    return (least <= label) & (label <= most) & (high >= part["worst"].to_numpy()[:, None])


def _windows(part: pa.Table) -> np.ndarray:
    """Positive scores as (anchor, FIRST); NaN where there are fewer."""
    found = np.full((part.num_rows, FIRST), np.nan)
    for i, scores in enumerate(part["scores"].to_pylist()):
        found[i, :len(scores)] = scores
    return found


def _other_label(part: pa.Table, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    label = part["label"].to_numpy()[:, None]
    needed = np.zeros(low.shape, bool)
    for p in _windows(part).T[:, :, None]:
        # comparisons with NaN are false
        needed |= (100 * high >= LOWEST * p - np.abs(p) * 1e-12) & (low <= p + np.abs(p) * 1e-12)
    return needed & ((least != label) | (most != label))


def _read(blocks: pa.Table, dims: int) -> Iterator[tuple]:
    for b in range(blocks.num_rows):
        row = {c: blocks[c][b] for c in blocks.column_names}
        ids = row["ids"].values.to_numpy()
        yield (ids, row["labels"].values.to_numpy(), np.frombuffer(row["vectors"].as_py(), np.float64).reshape(len(ids), dims),
               *(np.frombuffer(row[c].as_py(), np.float64)[None] for c in ("lo", "hi")),
               np.array([row["least"].as_py()]), np.array([row["most"].as_py()]))


def _long(values: np.ndarray) -> pa.Array:
    return pa.array([int(v) for v in values], pa.int64())


def _positives(blocks: pa.Table, anchors: pa.Table, dims: int) -> pa.Table:
    out = []
    for at in range(0, anchors.num_rows if blocks.num_rows else 0, _PIECE):
        part = anchors.slice(at, _PIECE)
        own, label, name = (part[c].to_numpy() for c in ("id", "label", "anchor"))
        vectors, tops = _matrix(part["vector"], dims), _Tops(part.num_rows)
        worst = part["worst"].to_numpy()
        for ids, labels, rows, lo, hi, least, most in _read(blocks, dims):
            low, high = _bounds(vectors, lo, hi)
            needed = np.flatnonzero(_same_label(part, low, high, least, most)[:, 0] & (high[:, 0] >= tops.worst))
            if not len(needed):
                continue
            scores, floor = _products(vectors[needed], rows), np.nextafter(np.maximum(worst, tops.worst), -np.inf)[needed, None]
            who, row = np.nonzero((label[needed, None] == labels) & (own[needed, None] != ids) & (scores >= floor).astype(bool))
            tops.add(needed[who], scores[who, row], ids[row])
        out.append(pa.table({"anchor": name[tops.who], "score": _long(tops.score), "row_id": tops.row_id}))
    return pa.concat_tables(out) if out else pa.table(
        {"anchor": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "row_id": pa.array([], pa.int64())})


def _negatives(blocks: pa.Table, anchors: pa.Table, dims: int) -> pa.Table:
    out = []
    for at in range(0, anchors.num_rows if blocks.num_rows else 0, _PIECE):
        part = anchors.slice(at, _PIECE)
        own, label, name = (part[c].to_numpy() for c in ("id", "label", "anchor"))
        exact = part["scores"].to_pylist()
        vectors, tops = _matrix(part["vector"], dims), [_Tops(part.num_rows) for _ in range(FIRST)]
        for ids, labels, rows, lo, hi, least, most in _read(blocks, dims):
            low, high = _bounds(vectors, lo, hi)
            needed = np.flatnonzero(_other_label(part, low, high, least, most)[:, 0])
            if not len(needed):
                continue
            scores = _products(vectors[needed], rows)
            other = (label[needed, None] != labels) & (own[needed, None] != ids)
            for n, top in enumerate(tops):
                # an empty window where there are fewer positives
                p = np.array([exact[a][n] if n < len(exact[a]) else -1 for a in needed], scores.dtype)[:, None]
                who, row = np.nonzero(other & (LOWEST * p <= 100 * scores).astype(bool) & (scores <= p).astype(bool))
                top.add(needed[who], scores[who, row], ids[row])
        for n, top in enumerate(tops):
            out.append(pa.table({"anchor": name[top.who], "n": np.full(len(top.who), n, np.int32), "score": _long(top.score),
                                 "row_id": top.row_id}))
    return pa.concat_tables(out) if out else pa.table({
        "anchor": pa.array([], pa.int64()), "n": pa.array([], pa.int32()), "score": pa.array([], pa.int64()),
        "row_id": pa.array([], pa.int64())})


def _cells(blocks: DataFrame, anchors: DataFrame, dims: int, wanted, read, schema: str) -> DataFrame:
    """``read`` applied to each group of blocks and the anchors that must read it, by the bounds of ``wanted``.

    The anchors are a stated set of queries that meets all zone maps, ``ZONES``
    times ``ANCHORS`` in a cell; only then anchors and the blocks that somebody
    needs are dealt to cells of one group each.
    """
    n_zones = -(-blocks.count() // ZONES) or 1
    n_batches = -(-anchors.count() // ANCHORS) or 1
    batch = lambda: F.pmod(F.xxhash64("anchor"), F.lit(n_batches)).cast("int").alias("batch")
    anchors = anchors.select("*", batch())
    zones = blocks.select("group", "lo", "hi", "least", "most", F.pmod(F.xxhash64("group"), F.lit(n_zones)).cast("int").alias("zone"))
    dealt = zones.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(n_batches - 1))))
    asking = anchors.withColumn("zone", F.explode(F.sequence(F.lit(0), F.lit(n_zones - 1))))
    needed = stored(dealt.groupBy("zone", "batch").cogroup(asking.groupBy("zone", "batch")).applyInArrow(
        lambda left, right: _met(left, right, dims, wanted), "anchor bigint, group bigint"), "needed")
    asking = needed.join(anchors, "anchor")
    cells = needed.select("group", batch()).distinct()
    return blocks.join(cells, "group").groupBy("group", "batch").cogroup(asking.groupBy("group", "batch")).applyInArrow(
        lambda left, right: read(left, right, dims), schema)


def hard_negatives(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """Per anchor and positive the first ``FIRST`` rows of other labels in the positive's window.

    ``rows`` has vec_id, embedding and label; ``is_anchor`` is a condition on
    them. Returns anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score.
    """
    found, dims = candidate_blocks(rows, is_anchor)
    blocks = found.drop("anchors").withColumn("group", F.shiftright("block", GROUP.bit_length() - 1))
    anchors = found.select("block", F.posexplode("anchors").alias("i", "a")).select(
        (F.col("block") * BLOCK + F.col("i")).alias("anchor"), "a.*")

    first = lambda by: F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), "row_id"))
    positives = _cells(blocks, anchors, dims, _same_label, _positives, "anchor bigint, score bigint, row_id bigint")
    positives = stored(positives.withColumn("n", first(["anchor"]) - 1).where(F.col("n") < FIRST), "positives")
    scores = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("n", "score"))).alias("found"))
    asking = stored(anchors.drop("worst").join(scores.select("anchor", F.col("found.score").alias("scores")), "anchor"), "anchors")

    negatives = _cells(blocks, asking, dims, _other_label, _negatives, "anchor bigint, n int, score bigint, row_id bigint")
    negatives = negatives.withColumn("rank", first(["anchor", "n"])).where(F.col("rank") <= FIRST)
    named = positives.join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor").select(
        "anchor", "n", "anchor_id", F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score"))
    known = lambda c: F.when(F.col(c) != int(_NO_ID), F.col(c)).alias(c)
    return negatives.select("anchor", "n", "rank", F.col("row_id").alias("negative_id"), F.col("score").alias("negative_score")).join(
        named, ["anchor", "n"]).select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100; labels of ids divisible by 7 are shifted first."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH vectors AS (
    SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
        list_transform(embedding, lambda v: floor(256 * CAST(v AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
        CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
    SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.row_id) AS INTEGER) AS rank,
    n.row_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= 5
"""
