"""Hard negatives against every pair worked out."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyforge.llm import hard_negatives
from replyforge.llm.hard_negatives import bounds, levels, mine, segments, store, summary

SCHEMA = "vec_id long, embedding array<float>, label int, n int, dim string, uids long"


def mine_by_hand(rows, is_anchor, positives=5, negatives=5):
    """Every anchor against every row with plain loops."""
    kept = []
    for key, vector, label, *_ in rows:
        if label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((key, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    found = []
    for i, (key, own, label) in enumerate(kept):
        if not is_anchor(key):
            continue
        scored = [
            (-sum(a * b for a, b in zip(own, v, strict=True)), k is None, k or 0, l)
            for j, (k, v, l) in enumerate(kept)
            if j != i and len(v) == len(own)
        ]
        for ps, p_null, p, _ in sorted(s for s in scored if s[3] == label)[:positives]:
            window = sorted(s for s in scored if s[3] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps)
            for rank, (ns, n_null, n, _) in enumerate(window[:negatives], 1):
                found.append((key, None if p_null else p, rank, None if n_null else n, -ps, -ns))
    return sorted(found, key=str)


def mined(spark, rows, monkeypatch=None, parts=3, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = mine(store(table, F.col("vec_id") % 10 == 0), **options)
    return sorted(map(tuple, found.collect()), key=str)


def made(seed, n, dim=20, labels=4):
    numbers = np.random.default_rng(seed)
    centres = numbers.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[numbers.integers(6)] + 0.4 * numbers.normal(size=dim)
        rows.append((i, [float(np.float32(x)) for x in v], int(numbers.integers(labels)), 1, "x", 2))
    return rows


@pytest.mark.parametrize("rows, tile, dense", [(4096, 256, 0.02), (64, 8, 0.02), (50, 16, 2.0)])
def test_made_vectors(spark, monkeypatch, rows, tile, dense):
    for name, value in (("ROWS", rows), ("TILE", tile), ("DENSE", dense)):
        monkeypatch.setattr(hard_negatives, name, value)
    data = made(1, 400)
    assert mined(spark, data) == mine_by_hand(data, lambda k: k % 10 == 0)


def test_blocks_of_anchors(spark):
    data = made(2, 300, dim=3)
    assert mined(spark, data, anchor_bytes=20_000) == mine_by_hand(data, lambda k: k % 10 == 0)


def test_ties_and_copies(spark):
    """A third of all rows hold one vector."""
    data = [(i, [1.0, 0.5, 0.0, 0.0, 0.25], i % 3, 1, "x", 2) for i in range(100)] + [(100 + i, v, l, *x) for i, (_, v, l, *x) in enumerate(made(3, 200, dim=5))]
    random.Random(1).shuffle(data)
    assert mined(spark, data) == mine_by_hand(data, lambda k: k % 10 == 0)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    data = [
        (10, [1.0, 2.0], 1),
        (10, [1.0, 2.0], 1),
        (11, [1.0, 1.9], 2),
        (12, [1.0, None], 1),
        (13, [1.0, nan], 1),
        (14, [1.0, inf], 2),
        (15, None, 1),
        (16, [1.0, 2.0], None),
        (17, [], 1),
        (20, [0.5, 0.5, 0.5], 2),
        (21, [0.5, 0.5, 0.6], 2),
        (22, [0.5, 0.5, 0.55], 1),
        (None, [1.0, 2.0], 2),
        (30, [-1.0, -2.0], 3),
        (31, [1.0, -0.1], 3),
        (40, [5000.0, 7000.0], 4),
        (41, [5000.0, 7100.0], 4),
        (42, [5000.0, 7000.0], 5),
    ]
    data = [(*r, 1, "x", 2) for r in data]
    assert mined(spark, data) == mine_by_hand(data, lambda k: k is not None and k % 10 == 0)


def test_large_components(spark):
    """Whole numbers beyond what doubles hold exactly."""
    numbers = random.Random(4)
    data = [(i, [float(np.float32(numbers.uniform(-9e5, 1.2e6))) for _ in range(6)], i % 3, 1, "x", 2) for i in range(80)]
    assert mined(spark, data) == mine_by_hand(data, lambda k: k % 10 == 0)


def test_bounds_hold_and_tighten():
    numbers = np.random.default_rng(5)
    for dim in (1, 2, 5, 16, 17, 64, 100):
        a, r = (np.floor(100 * numbers.normal(size=(20, dim)) + 30 * numbers.normal(size=(20, 1))) for _ in range(2))
        va, vr = (hard_negatives.Vectors(dim, *[np.arange(20)] * 3, x, *summary(x)) for x in (a, r))
        exact, before = a @ r.T, np.inf
        for level in range(len(levels(*summary(a), dim))):
            low, high = bounds(va, vr, level)
            assert (low <= exact).all() and (exact <= high).all()
            assert (high - low).mean() <= before + 1e-6
            before = (high - low).mean()
        assert len(segments(dim, 16)) == min(dim, 16)


def test_levels_leave_out_pairs():
    """Rows of segments unlike the anchor's are never multiplied out."""
    numbers = np.random.default_rng(6)
    near, far = numbers.normal(size=(50, 64)) + 8, numbers.normal(size=(2000, 64)) - 8
    content = np.floor(256 * np.concatenate([near, far]))
    rows = hard_negatives.Vectors(64, np.arange(2050), np.arange(2050), np.zeros(2050, int), content, *summary(content))
    anchors, counted = rows.pick(np.arange(5)), []
    original = hard_negatives.scores_of
    try:
        hard_negatives.scores_of = lambda a, r, pairs: counted.append(len(pairs[0])) or original(a, r, pairs)
        least = np.full(5, int(0.5 * (content[0] @ content[1])))
        a, r, _ = hard_negatives.filtered(anchors, rows, np.ones((5, 2050), bool), least, None)
    finally:
        hard_negatives.scores_of = original
    assert set(r.tolist()) <= set(range(50)) and sum(counted) <= 250


def test_no_rows(spark):
    assert mine(store(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0)).collect() == []
    assert mined(spark, [(1, [1.0], 1, 1, "x", 2)], parts=1) == []
    assert mined(spark, [(10, [1.0], 1, 1, "x", 2)], parts=1) == []
