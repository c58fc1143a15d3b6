"""Hard negatives against a plain loop."""

import math
import random

import numpy as np
import pytest

from shelfaudit.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, row long, v double, slice int, group string, positives int"
EXTRA = (-1, 0.5, -2, "x", -3)


def brute(rows, every=100, relabel=7, labels=10, n_pos=5, n_neg=5, low=80, high=100, scale=256):
    """rows: (vec_id, vector, label) as stored."""
    own = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % relabel == 0:
            label = (label + 1) % labels
        own.append((i, [math.floor(scale * float(np.float32(x))) for x in v], label))
    last = lambda i: (i is None, i or 0)
    score = lambda a, b: max(-hn._LARGEST, min(hn._LARGEST, sum(x * y for x, y in zip(a, b))))
    out = []
    for k, (i, v, label) in enumerate(own):
        if i is None or i % every:
            continue
        scored = [(-score(v, w), last(j), j, m) for n, (j, w, m) in enumerate(own) if n != k]
        for p in sorted((x for x in scored if x[3] == label), key=lambda x: x[:2])[:n_pos]:
            fits = [x for x in scored if x[3] != label and low * -p[0] <= 100 * -x[0] <= high * -p[0]]
            for rank, x in enumerate(sorted(fits, key=lambda x: x[:2])[:n_neg], 1):
                out.append((i, p[2], rank, x[2], -p[0], -x[0]))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = hn.hard_negatives(spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA), **options)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()), key=str)


def vectors(n, d, seed, size=1.0):
    draw = np.random.default_rng(seed)
    return (draw.normal(0, size, (n, d)) + 0.4 * size).astype(np.float32).tolist()


@pytest.mark.parametrize("pack", [3, 2048])
def test_equals_brute_force(spark, monkeypatch, pack):
    monkeypatch.setattr(hn, "PACK", pack)
    monkeypatch.setattr(hn, "SLICE", 40)
    monkeypatch.setattr(hn, "GROUP", 2)
    draw = random.Random(1)
    rows = [(i, v, draw.randrange(3)) for i, v in enumerate(vectors(400, 6, 2))]
    rows += [(400 + i, rows[0][1], 1) for i in range(60)]  # one vector many times: ties
    rows += [(0, rows[5][1], 1), (100, rows[9][1], 0), (100, rows[9][1], 0), (None, rows[7][1], 1), (None, rows[7][1], 2)]  # ids again, or none
    rows += [(700, None, 1), (800, [0.1] * 6, None), (900, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1), (1000, [math.nan] + [0.0] * 5, 2), (1100, [math.inf] * 6, 0)]
    rows += [(1200, [], 1), (1300, [0.5, 0.25], 2), (1400, [0.0] * 6, 0), (1500, [-1.0] * 6, 1)]
    want = brute(rows, every=50)
    assert len(want) > 50
    assert run(spark, rows, anchor_every=50) == want


def test_large_components_are_exact_or_cut(spark):
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(40, 4, 3, 3e6))]
    rows += [(100, [3e7, 1.0, -2.0, 1e6], 0), (101, [1e30, -1e30, 3e38, 0.0], 0), (200, [1e30, 1.0, 1e20, -3.0], 1), (201, [2e30, 0.0, 0.0, 0.0], 1)]
    assert run(spark, rows, anchor_every=20, relabel_every=7) == brute(rows, every=20)


def test_packed_scores_at_every_width():
    draw = np.random.default_rng(4)
    for size in (3, 300, 70_000, 2**23):
        c, a = draw.integers(-size, size + 1, (37, 9)), draw.integers(-size, size + 1, (5, 9))
        pack = hn.Packed(c, int(np.abs(a).max()))
        for row in a:
            assert pack.scores([int(x) for x in row]).tolist() == (c @ row).tolist()
    wide = hn.Packed(np.array([[10**20, 1], [-(10**20), 2]], object), 10**3)
    assert wide.width > 8 and wide.scores([0, 1000]).tolist() == [1000, 2000] and wide.scores([1000, 0]).tolist() == [hn._LARGEST, -hn._LARGEST]


def test_without_anchors_rows_or_positives(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert run(spark, [(100, [1.0], 1), (2, [1.0], 2)]) == []
    assert run(spark, [(100, [1.0], 1), (2, [1.0], 1)]) == []
