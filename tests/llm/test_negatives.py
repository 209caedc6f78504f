import math
import random

import numpy as np
import pytest

from sensorlake.llm import negatives as ng

KIND = "vec_id long, label int, embedding array<float>, x int, part string, score int"
IS_ANCHOR = "vec_id % 10 = 0"


def brute(rows, positives=5, negatives=10, low=30, high=90):
    ok = [(i, y, v) for i, y, v in rows if i is not None and y is not None and v
          and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for *_, v in ok]
    d = max(sizes, key=lambda s: (sizes.count(s), s), default=0)
    ok = [(i, y, [math.floor(256 * float(np.float32(c))) for c in v]) for i, y, v in ok if len(v) == d]
    anchors = {}
    for i, y, x in ok:
        if i % 10 == 0:
            anchors[i] = min(anchors.get(i, (y, x)), (y, x))
    out = []
    for a, (label, v) in anchors.items():
        scored = sorted((-sum(p * q for p, q in zip(v, x)), i, y) for i, y, x in ok if i != a)
        for s, p, _ in [t for t in scored if t[2] == label][:positives]:
            fits = [t for t in scored if t[2] != label and low * -s <= 100 * -t[0] <= high * -s]
            for rank, t in enumerate(fits[:negatives], 1):
                out.append((a, p, rank, t[1], -s, -t[0]))
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "p", 2) for r in rows], KIND)
    got = ng.mined(df, IS_ANCHOR)
    assert got.columns == [c.split()[0] for c in ng._RESULT.split(", ")]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def vectors(seed, n, d, labels):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, d))
    y = rng.integers(0, labels, n)
    x = centres[y] * 0.5 + rng.standard_normal((n, d)) * 0.5
    return [(i, int(l), v.tolist()) for i, (l, v) in enumerate(zip(y, x))]


@pytest.mark.parametrize("n,d,labels", [(400, 6, 3), (700, 16, 5), (60, 2, 60)])
def test_against_all_scores(spark, n, d, labels):
    check(spark, vectors(n, n, d, labels))


def test_many_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ng, "TILE_CELLS", 500)
    monkeypatch.setattr(ng, "BLOCK_CELLS", 40)
    monkeypatch.setattr(ng, "FIRST_SEARCH", 4)
    check(spark, vectors(1, 600, 4, 3))


def test_ties_copies_and_defects(spark):
    rows = vectors(2, 150, 3, 2)
    rng = random.Random(1)
    rng.shuffle(rows)
    rows += [(1000 + i, i % 2, [1.0, 1.0, 1.0]) for i in range(300)]  # one vector, hot
    rows += [(20, 1, [0.5, 0.5, 0.5]), (20, 1, [0.5, 0.5, 0.5]), (7, 0, [1.0, 0.0, 0.0])]
    rows += [(None, 0, [1.0, 1.0, 1.0]), (2000, None, [1.0] * 3), (2010, 0, None), (2020, 0, [])]
    rows += [(2030, 0, [1.0, None, 1.0]), (2040, 0, [float("nan")] * 3), (2050, 0, [1.0, 1.0])]
    rows += [(2060, 0, [float("inf"), 0.0, 0.0]), (2070, 1, [0.0] * 3), (-10, 1, [1.0, 1.0, 0.9])]
    check(spark, rows)


def test_large_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, i % 2, [rng.uniform(-1, 1) * 4e6 for _ in range(4)]) for i in range(80)]
    check(spark, rows)


def test_nothing(spark):
    check(spark, [(1, 0, [1.0]), (2, 1, [1.0])])  # no anchor
    check(spark, [(10, 0, [1.0]), (2, 1, [1.0])])  # no positive
    df = spark.createDataFrame([], KIND)
    assert ng.mined(df, IS_ANCHOR).collect() == []


def _tree(rng, n, d):
    x = rng.integers(-50, 50, (n, d)) + 100 * rng.integers(-3, 4, (n, 1))
    labels = rng.integers(0, 4, n)
    order = ng.packed_order(labels, x)
    assert sorted(order) == list(range(n))
    return ng.Tree(np.arange(n)[order], labels[order], x[order].astype(np.float64))


def test_boxes_bound_their_rows():
    rng = np.random.default_rng(5)
    tree = _tree(rng, 3000, 5)
    anchors = rng.integers(-60, 60, (9, 5))
    least, most = tree.bounds(anchors)
    scores = tree.x @ anchors.T
    for node in range(len(tree.children)):
        below = [node]
        while below[0] >= tree.leaves:
            below = [c for n in below for c in tree.children[n]]
        rows = np.concatenate([scores[n * ng.LEAF : (n + 1) * ng.LEAF] for n in below])
        assert (rows >= least[:, node]).all() and (rows <= most[:, node]).all()


def test_queue_opens_few_boxes():
    rng = np.random.default_rng(6)
    tree = _tree(rng, 20_000, 3)
    anchor = np.array([3, 2, 1])
    least, most = tree.bounds(anchor[None])
    opened = []
    best = tree.best(-1, anchor.astype(float), 9, False, [(-np.inf, np.inf, -np.inf)], 5, least[0],
                     most[0], opened)
    scores = tree.x @ anchor
    assert [-s for s, _ in best[0]] == sorted(scores, reverse=True)[:5]
    assert len(opened) < tree.leaves / 4
    window = (100.0, 120.0, -np.inf)
    opened = []
    best = tree.best(-1, anchor.astype(float), 9, False, [window], 5, least[0], most[0], opened)
    inside = sorted(scores[(scores >= 100) & (scores <= 120)], reverse=True)
    assert [-s for s, _ in best[0]] == inside[:5]
    assert len(opened) < tree.leaves / 2
