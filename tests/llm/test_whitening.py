import math

import numpy as np
import pytest

from sensorlake.llm import whitening as wh

KIND = "vec_id long, embedding array<float>, label int, x int, n string"


def frame(spark, vectors, ids=None):
    ids = ids or range(len(vectors))
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 0, 9, "n")
            for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, KIND)


def brute(vectors, k=4):
    """{place: (deviation, whitened up to sign)}, explained and n, with numpy."""
    ok = [i for i, v in enumerate(vectors)
          if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    d = max({len(vectors[i]) for i in ok}, key=lambda s: (sum(len(vectors[i]) == s for i in ok), s))
    ok = [i for i in ok if len(vectors[i]) == d]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in vectors[i]] for i in ok])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    mean = s / n
    v = (fit - mean).T @ (fit - mean) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    good = e > d * 2.3e-16 * max(np.trace(v), 0)
    e, u = e[good], u[:, good]
    white = (x - mean) @ u / np.sqrt(e)
    deviation = ((n * x.astype(object) - s.astype(object)) ** 2).sum(axis=1)
    return n, e / np.trace(v), {i: (int(t), w) for i, t, w in zip(ok, deviation, white)}


def check(spark, vectors):
    n, explained, want = brute(vectors)
    rows = wh.whitened(frame(spark, vectors)).collect()
    assert len(rows) == len(want) * len(explained)
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(got) == set(want)
    signs = None
    for i, (deviation, white) in want.items():
        mine = [got[i][c + 1] for c in range(len(explained))]
        assert {r["deviation"] for r in mine} == {deviation}
        assert {r["n"] for r in mine} == {n}
        assert max(r["identity_error"] for r in mine) < 1e-9
        np.testing.assert_allclose([r["explained"] for r in mine], explained, rtol=1e-9)
        w = np.array([r["whitened"] for r in mine])
        if signs is None and (np.abs(white) > 1e-3).all():
            signs = np.sign(w * white)
        if signs is not None:
            np.testing.assert_allclose(w * signs, white, atol=1e-7)


def test_inertia():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 8, 33):
        for _ in range(20):
            a = rng.standard_normal((d, d))
            a = a + a.T
            e = np.linalg.eigvalsh(a)
            assert wh.inertia(a) == ((e < 0).sum(), 0, (e > 0).sum())
    assert wh.inertia([[0.0, 1.0], [1.0, 0.0]]) == (1, 0, 1)
    assert wh.inertia(np.zeros((3, 3))) == (0, 3, 0)
    assert wh.inertia(np.diag([2.0, 0.0, -1.0])) == (1, 1, 1)


@pytest.mark.parametrize(
    "values",
    [
        [9, 7, 5, 3, 1, 0.5],
        [5, 5, 5, 5, 2, 1],  # one value many times
        [1e12, 1e6, 1, 1e-3, 0, 0],
        [3, 3 - 1e-9, 2, 1, 1, 1],  # close ones
        [4, 2, 0, 0, 0, 0],
        [1, 1, 1, 1, 1, 1],
    ],
)
def test_leading(values):
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((6, 6)))
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    e, u = wh.leading(a)
    want = [v for v in np.linalg.eigvalsh(a)[::-1][:4] if v > 6 * 2.3e-16 * np.trace(a)]
    np.testing.assert_allclose(e, want, rtol=1e-9, atol=1e-15 * max(values))
    np.testing.assert_allclose(u @ u.T, np.eye(len(e)), atol=1e-12)
    assert np.abs(a @ u.T - u.T * e).max() <= 1e-13 * max(values)


def test_number_is_certified():
    spectrum = wh.Spectrum(np.diag([4.0, 3.0, 2.0, 1.0]))
    assert spectrum.above(2.5) == 2
    assert [round(spectrum.next()[0], 9) for _ in range(4)] == [4, 3, 2, 1]
    assert not spectrum._is_number(1, 3.0)
    assert spectrum._is_number(2, 3.0)


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((300, 12)) * np.linspace(3, 0.2, 12)).tolist()
    check(spark, vectors + vectors[:50] + [vectors[7]] * 100)


def test_defects(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((60, 5)).tolist()
    vectors += [None, [], [1.0, None, 2, 3, 4], [float("nan")] * 5, [float("inf")] + [0.0] * 4,
                [1.0, 2.0], [1e5, 0, 0, 0, 0], [-0.0] * 5]
    check(spark, vectors)


def test_few_vectors(spark):
    check(spark, [[0.0, 1.0, 2.0], [4.0, 1.0, 0.0]])  # one direction only
    one = wh.whitened(frame(spark, [[1.0, 2.0]] * 3))
    assert one.collect() == []
    none = wh.whitened(frame(spark, [None, []]))
    assert none.collect() == [] and none.dtypes == one.dtypes
    assert wh.whitened(frame(spark, [[1.0]]).limit(0)).collect() == []


def test_large_sums_are_exact(spark):
    """Values so large that doubles would round their products."""
    rng = np.random.default_rng(5)
    check(spark, (rng.standard_normal((40, 3)) * 1e5).tolist())


def test_null_and_repeated_ids(spark):
    df = frame(spark, [[1.0, 0.0], [0.0, 1.0], [2.0, 2.0], [2.0, 2.0]], [None, 1, 1, None])
    rows = wh.whitened(df).collect()
    assert len(rows) == 8 and {r["n"] for r in rows} == {3}
