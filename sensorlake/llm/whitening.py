"""Whitening of embeddings by the leading components of their covariance.

1. The fit list is each distinct integer vector once. Its sums and products are taken in
   tasks, exactly, after subtracting a whole number near the mean of each dimension.
2. The covariance (dimensions squared) is what reaches the driver. Its leading eigenvalues
   come by spectrum slicing: the signs of the pivots of a block LDL^T factorisation of
   V - s I count the eigenvalues above s (Sylvester's law of inertia). Bisection by these
   counts isolates the k-th eigenvalue, Rayleigh quotient iteration converges to it, and
   the counts on both sides of the result certify its number.
3. Rows are projected in tasks.

Eigenvalues that no count can tell apart at double precision are a cluster; its vectors are
kept orthogonal to each other, and which of them comes first is not defined. A component
whose eigenvalue is zero to rounding cannot be scaled and is left out, so a table with one
distinct vector gives no rows. Rows with a null, empty or non-finite vector take no part,
nor do vectors whose length is not the most frequent one. Repeated rows are projected each,
and count once in the fit. A null vec_id is kept. An empty table gives no rows. Other columns
are left out, whatever their names.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sensorlake.llm.vectors import common_size, matrix, product, with_integers
from sensorlake.session import written

COMPONENTS = 4
_EPS = float(np.finfo(np.float64).eps)
#: A diagonal pivot is taken if it is not much smaller than the largest other entry
#: (the ratio that bounds the growth of one 2 x 2 step by that of two 1 x 1 steps).
_PIVOT_RATIO = (1 + 17**0.5) / 8


# Spectrum slicing ------------------------------------------------------------------------


def inertia(a):
    """(negative, zero, positive) numbers of eigenvalues of a symmetric matrix, by LDL^T
    with complete pivoting over 1 x 1 and 2 x 2 blocks."""
    a = np.array(a, np.float64)
    tiny = _EPS * np.abs(a).max(initial=0) * len(a)
    negative = positive = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        if max(diagonal[p], off[i, j]) <= tiny:
            return negative, len(a), positive
        if diagonal[p] >= _PIVOT_RATIO * off[i, j]:
            block, signs = [p], [a[p, p]]
        else:
            block = [int(i), int(j)]
            signs = [-1.0, 1.0]  # the determinant of such a block is negative
        negative += sum(s < 0 for s in signs)
        positive += sum(s > 0 for s in signs)
        rest = np.setdiff1d(np.arange(len(a)), block)
        side = a[np.ix_(rest, block)]
        pivot = a[np.ix_(block, block)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pivot, side.T)
        a = (a + a.T) / 2
    return negative, 0, positive


def _solved(a, shift, x):
    """(a - shift I)^-1 x; a shift that is an eigenvalue to the last bit is moved a little."""
    for step in (0.0, 1.0, 16.0, 256.0):
        moved = shift + step * _EPS * max(1.0, np.abs(a).max())
        try:
            y = np.linalg.solve(a - moved * np.eye(len(a)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    raise ArithmeticError("no solution near the shift")


def _unit(x, against):
    for _ in range(2):
        for u in against:
            x = x - (u @ x) * u
    return x / np.linalg.norm(x)


class Spectrum:
    """The largest eigenvalues of a symmetric matrix and their vectors, one after another."""

    def __init__(self, a):
        self.a = np.array(a, np.float64)
        self.bound = float(np.abs(self.a).sum(axis=1).max(initial=0))  # after Gershgorin
        self.margin = 4 * _EPS * len(self.a) * self.bound
        self.values, self.vectors = [], []

    def above(self, shift):
        """How many eigenvalues are larger than the shift."""
        return inertia(self.a - shift * np.eye(len(self.a)))[2]

    def next(self):
        """(value, unit vector) of the next smaller eigenvalue."""
        k = len(self.values) + 1
        lo = -self.bound - self.margin
        hi = (self.values[-1] if self.values else self.bound) + 2 * self.margin
        above_lo, above_hi = len(self.a), self.above(hi)
        while True:
            # isolate, as far as rounding allows
            while (above_lo > k or above_hi < k - 1) and hi - lo > 2 * self.margin:
                lo, hi, above_lo, above_hi = self._halved(k, lo, hi, above_lo, above_hi)
            value, vector = self._iterated((lo + hi) / 2)
            if lo - self.margin <= value <= hi + self.margin and self._is_number(k, value):
                break
            if hi - lo <= 2 * self.margin:
                raise ArithmeticError(f"eigenvalue {k} cannot be certified")
            lo, hi, above_lo, above_hi = self._halved(k, lo, hi, above_lo, above_hi)
        vector = vector if vector[np.abs(vector).argmax()] > 0 else -vector
        self.values.append(value)
        self.vectors.append(vector)
        return value, vector

    def _halved(self, k, lo, hi, above_lo, above_hi):
        middle = (lo + hi) / 2
        n = self.above(middle)
        return (middle, hi, n, above_hi) if n >= k else (lo, middle, above_lo, n)

    def _iterated(self, shift):
        """Inverse iteration from the middle, then with the Rayleigh quotient as the shift."""
        x = _unit(np.random.default_rng(7).standard_normal(len(self.a)), self.vectors)
        for _ in range(2):
            x = _unit(_solved(self.a, shift, x), self.vectors)
        for _ in range(12):
            value = float(x @ self.a @ x)
            if np.linalg.norm(self.a @ x - value * x) <= 2 * _EPS * self.bound:
                break
            x = _unit(_solved(self.a, value, x), self.vectors)
        return float(x @ self.a @ x), x

    def _is_number(self, k, value):
        return self.above(value - self.margin) >= k > self.above(value + self.margin)


def leading(a, count=COMPONENTS):
    """Up to ``count`` eigenvalues above zero, largest first, with unit vectors in rows."""
    spectrum = Spectrum(a)
    floor = len(spectrum.a) * _EPS * max(0.0, float(np.trace(spectrum.a)))
    for _ in range(min(count, len(spectrum.a))):
        if spectrum.above(floor) <= len(spectrum.values):
            break
        spectrum.next()
    return np.array(spectrum.values), np.array(spectrum.vectors).reshape(-1, len(spectrum.a))


# Sums in tasks ---------------------------------------------------------------------------


def _summed(key, table):
    """The sum of what the tasks have for one row of a matrix of sums."""
    total = [sum(column) for column in zip(*table["sums"].to_pylist())]
    if any(abs(v) >= 1 << 63 for v in total):
        raise OverflowError("a sum over the fit list does not fit 64 bits")
    return pa.table([pa.array([key[0].as_py()]), pa.array([total], pa.list_(pa.int64()))], ["i", "sums"])


def _sums(fitted, d, of):
    """The sum of ``of(x)``, some rows of d integers for a matrix x, over all tasks."""

    def partial(batches):
        total = None
        for batch in batches:
            part = of(matrix(batch["x"], d)).astype(object)
            total = part if total is None else total + part
        if total is not None:
            rows = [[int(v) for v in row] for row in total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.list_(pa.int64()))],
                ["i", "sums"],
            )

    kind = "i long, sums array<long>"
    parts = fitted.select("x").mapInArrow(partial, kind)
    rows = parts.groupBy("i").applyInArrow(_summed, kind).collect()
    return [r["sums"] for r in sorted(rows)]


def _total(x):
    return product(np.ones((1, len(x)), np.int64), x)


class Fit:
    """n and sums of the fit list, its covariance, and the leading components."""

    def __init__(self, fitted, d, components=COMPONENTS):
        self.d = d
        self.sums, (self.n, *_) = _sums(
            fitted, d, lambda x: np.concatenate([_total(x), np.full((1, d), len(x))])
        )
        middle = np.array([round(s / self.n) for s in self.sums], np.int64)

        def centred(x):
            y = x - middle
            return np.concatenate([_total(y), product(y.T, y)])

        first, *second = _sums(fitted, d, centred)
        n = self.n
        # whole numbers of any size; each division is rounded once
        self.covariance = np.array(
            [[(n * c - a * b) / (n * n) for c, b in zip(row, first)] for a, row in zip(first, second)]
        )
        self.trace = float(np.trace(self.covariance))
        self.values, self.vectors = leading(self.covariance, components)

    def projected(self, x):
        """Struct of ``deviation`` and ``whitened`` (an array) of a column of vectors."""
        n, d, sums, limit = self.n, self.d, self.sums, 1 << 63
        turn = (self.vectors / np.sqrt(self.values)[:, None]).T

        @F.arrow_udf("struct<deviation:bigint,whitened:array<double>>")
        def of(column: pa.Array) -> pa.Array:
            x = matrix(column, d)
            most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
            if most * most * d < limit:
                y = n * x - np.array(sums, np.int64)
            else:
                y = n * x.astype(object) - np.array(sums, object)
            deviation = (y * y).sum(axis=1)
            if len(y) and int(deviation.max()) >= limit:
                raise OverflowError("a deviation does not fit 64 bits")
            white = (y / n).astype(np.float64) @ turn
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * turn.shape[1])
            return pa.StructArray.from_arrays(
                [
                    pa.array(deviation.astype(np.int64)),
                    pa.ListArray.from_arrays(ends, pa.array(white.reshape(-1))),
                ],
                ["deviation", "whitened"],
            )

        return of(x)

    def identity_error(self, fitted):
        """Largest entry of the covariance of the whitened fit list, less the identity."""
        k = len(self.values)
        white = fitted.select(self.projected(F.col("x"))["whitened"].alias("w"))
        pairs = [(i, j) for i in range(k) for j in range(i + 1)]
        w = [F.get("w", F.lit(i)) for i in range(k)]
        row = white.agg(*[F.covar_pop(w[i], w[j]) for i, j in pairs]).first()
        return max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs))


# The operator ----------------------------------------------------------------------------

_RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(embeddings, components=COMPONENTS):
    """A row per vector and component: vec_id, component, n, deviation, whitened,
    explained and identity_error."""
    spark = embeddings.sparkSession
    rows = with_integers(embeddings.select("vec_id", "embedding")).select("vec_id", "x")
    rows = written(rows, "vectors")
    d = common_size(rows)
    rows = rows.where(F.size("x") == d)
    fitted = written(rows.select("x").distinct(), "fit-list")
    fit = Fit(fitted, d, components) if d else None
    if fit is None or not len(fit.values):
        kind = rows.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, {_RESULT}")
    error = fit.identity_error(fitted)
    share = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values])
    placed = rows.select("vec_id", fit.projected(F.col("x")).alias("p"))
    placed = placed.select("vec_id", "p.deviation", F.posexplode("p.whitened").alias("at", "whitened"))
    return placed.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
