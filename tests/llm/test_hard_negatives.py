"""Hard negatives against a plain loop over all rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, anchor string, place binary, score double, batch int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def _spark_rows(rows):
    return [(*r, "clash", b"x", 0.5, 3) for r in rows]


def _plain(rows) -> list[tuple]:
    kept = {}
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in vector)
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept[vec_id, whole + (0,) * (9 - len(whole)), label] = None
    out = []
    for a_id, a, a_label in kept:
        if a_id is None or a_id % 100:
            continue
        scored = sorted(
            ((-sum(x * y for x, y in zip(a, v, strict=True)), math.inf if i is None else i, label) for i, v, label in kept if i != a_id))
        for p, p_id, _ in [r for r in scored if r[2] == a_label][:5]:
            window = [r for r in scored if r[2] != a_label and 80 * -p <= 100 * -r[0] <= 100 * -p][:5]
            none = lambda i: None if i == math.inf else i
            out += [(a_id, none(p_id), n, none(r[1]), -p, -r[0]) for n, r in enumerate(window, 1)]
    return sorted(out, key=str)


def _ours(spark, rows, tmp_path, name) -> list[tuple]:
    spark.createDataFrame(_spark_rows(rows), SCHEMA).repartition(3).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    df = hn.op11_hard_negatives(spark, f"{tmp_path}/{name}")
    assert [c.lower() for c in df.columns] == NAMES
    assert [t for _, t in df.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    return sorted(map(tuple, df.collect()), key=str)


def _random(seed: int, n: int, dims: int, labels: int, step: float) -> list[tuple]:
    rng = np.random.default_rng(seed)
    vectors = np.round(rng.normal(0.1, 0.5, (n, dims)) / step) * step
    return [(i, [float(x) for x in v], int(rng.integers(labels))) for i, v in enumerate(vectors)]


@pytest.mark.parametrize(("seed", "dims", "labels", "step"), [(1, 9, 10, 1 / 256), (2, 2, 3, 0.25), (3, 5, 2, 0.5)])
def test_equals_a_loop_over_all_rows(spark, tmp_path, seed, dims, labels, step):
    rows = _random(seed, 901, dims, labels, step)
    expected = _plain(rows)
    assert expected
    assert _ours(spark, rows, tmp_path, "random") == expected


def test_odd_rows(spark, tmp_path):
    rows = _random(4, 450, 6, 4, 0.25)
    hot = rows[100][1]
    rows += [(1000 + i, hot, i % 3) for i in range(400)]  # one vector holds much of the table
    rows += rows[:150] + rows[100:101]  # repeated rows
    rows += [(200, [0.5] * 6, 1), (200, [0.25] * 6, 2)]  # one id, other vectors
    rows += [(None, hot, 1), (None, hot, 2), (-100, hot, 1), (-7, hot, 0)]
    rows += [(2000, None, 1), (2100, [], 1), (2200, [1.0, None], 1), (2300, [1.0, math.nan], 1), (2400, [math.inf], 2),
             (2500, hot, None), (2600, [0.5, 0.5], 3), (2700, [0.75] * 9, 3)]
    expected = _plain(rows)
    assert len({r[0] for r in expected}) > 5
    assert _ours(spark, rows, tmp_path, "odd") == expected


def test_no_rows_and_no_partners(spark, tmp_path):
    assert _ours(spark, [], tmp_path, "none") == []
    assert _ours(spark, [(0, [1.0], 1)], tmp_path, "one") == []
    assert _ours(spark, [(0, [], 1), (1, [], 2), (2, [], 1), (100, [], 5)], tmp_path, "empty") == _plain(
        [(0, [], 1), (1, [], 2), (2, [], 1), (100, [], 5)])


def test_large_components_are_exact(spark, tmp_path):
    rows = [(i, [float(2**21 + i % 5), float(i % 3)], i % 4) for i in range(120)]
    assert _ours(spark, rows, tmp_path, "large") == _plain(rows)


def test_many_cells_change_nothing(spark, tmp_path, monkeypatch):
    rows = _random(5, 600, 4, 5, 0.125)
    for name, value in (("GROUP", 1), ("ZONES", 3), ("ANCHORS", 2)):
        monkeypatch.setattr(hn, name, value)
    assert _ours(spark, rows, tmp_path, "cells") == _plain(rows)


def test_bounds_spare_blocks_that_cannot_hold_an_answer(spark):
    # 16 far clusters in two dimensions: an anchor's windows meet few of the blocks
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in (i % 16 * 4 + rng.random(), (i % 16 * 7) % 16 * 4 + rng.random())], i % 2) for i in range(16384)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    blocks, dims = hn.candidate_blocks(df, F.col("vec_id") % 100 == 0)
    zones = blocks.toPandas()
    lo, hi = (np.stack([np.frombuffer(z) for z in zones[c]]) for c in ("lo", "hi"))
    assert (hi - lo).max(axis=1).mean() < (hi.max() - lo.min()) / 2
    anchor = np.array([[256.0, -256.0]])
    low, high = hn._bounds(anchor, lo, hi)
    true = [anchor @ np.frombuffer(z).reshape(-1, dims).T for z in zones["vectors"]]
    assert all(a <= t.min() and t.max() <= b for a, b, t in zip(low[0], high[0], true, strict=True))
    assert (high[0] >= max(t.max() for t in true)).mean() < 0.25


def test_neighbours_on_the_curve_touch():
    grid = np.array(np.meshgrid(*[range(8)] * 3)).reshape(3, -1).T
    keys = hn.hilbert_keys(grid, 3)
    assert len(set(keys)) == 512
    walk = grid[sorted(range(512), key=lambda i: keys[i])]
    assert set(np.abs(np.diff(walk, axis=0)).sum(axis=1)) == {1}
