"""Embedding whitening by a bidiagonal qd solver.

Entries become whole numbers, x = floor(64 c) + 1000000.  The fit list holds each distinct x vector
once: n vectors with sums S.  Its rows are centred exactly, (n x - S) / n, and every task reduces
its blocks of them to one triangular factor (QR of the factor so far stacked on the next block).
Factors meet in groups of bounded size, level by level, until one R is left: R'R / n is the
covariance, which is never formed.

R is as large as the vectors are wide, whatever the number of rows.  Householder reflections bring it to
bidiagonal form B.  Its singular values come from dqds (differential quotient-difference with shifts),
which works on the squares of B's entries without subtractions but for the shift, so small values are
accurate too.  The right singular vectors of B are eigenvectors of B'B = L D L'; for each
value, stationary and progressive qd give the two factorisations of L D L' - s^2, which are joined (twisted) where
they leave the smallest remainder, and the vector follows by multiplications alone.  Vectors of values that lie close
together are made orthogonal in inverse iterations.  Reflections applied back give the directions.

A row's whitened value is its centred vector on a direction over the square root of the eigenvalue
s^2 / n.  A last pass over the fit list measures the covariance of the whitened vectors.

Defined cases: rows whose vector is null or holds a null or non-finite entry are dropped; repeated vectors are one
row of the fit list and all get results; null and repeated ids are kept; a vector shorter than the longest counts as
filled up with entries c = 0; directions without variance (s under 1e-11 of the largest) have no
whitening and no rows, so equal vectors only, or a single one, give an empty result, as an empty
table does; the sign of a direction makes its largest entry positive (ties: the first);
deviation is null if it exceeds a long; x must stay under 2^53 / n.  Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize

SCALE, OFFSET = 64, 1_000_000
_EPS = float(np.finfo(float).eps)
_FAN = 32  # factors that meet in one task


def usable(vec: Column) -> Column:
    return vec.isNotNull() & ~F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))


# ---------------------------------------------------------------- the solver

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, v): r = u B v' with diagonal a and superdiagonal b of B."""
    m, d = r.astype(float).copy(), r.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0:
            return None
        h = x.copy()
        h[0] += math.copysign(size, x[0])
        return h / np.linalg.norm(h)

    for i in range(d):
        h = reflector(m[i:, i])
        if h is not None:
            m[i:, i:] -= 2 * np.outer(h, h @ m[i:, i:])
        if i < d - 2:
            h = reflector(m[i, i + 1:])
            if h is not None:
                m[i:, i + 1:] -= 2 * np.outer(m[i:, i + 1:] @ h, h)
                v[:, i + 1:] -= 2 * np.outer(v[:, i + 1:] @ h, h)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One transform, and the least d; a negative one means that the shift is too large."""
    nq, ne = [0.0] * len(q), [0.0] * len(e)
    d = least = q[0] - shift
    for i in range(len(e)):
        nq[i] = d + e[i]
        if nq[i] == 0:
            d = q[i + 1] - shift
        else:
            t = q[i + 1] / nq[i]
            ne[i] = e[i] * t
            d = d * t - shift
        least = min(least, d)
        if not math.isfinite(d):
            return nq, ne, -math.inf
    nq[-1] = d
    return nq, ne, least


def squared_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal (a, b), falling."""
    size = max(float(np.abs(a).max(initial=0)), float(np.abs(b).max(initial=0)))
    if size == 0:
        return np.zeros(len(a))
    out, blocks = [], [([float(x / size) ** 2 for x in a], [float(x / size) ** 2 for x in b], 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        for _ in range(200 * len(q) + 200):
            cut = next((i for i in range(len(e) - 1, -1, -1)
                        if e[i] <= _EPS ** 2 * (moved + min(q[i], q[i + 1])) or e[i] < 1e-300), None)
            if len(q) == 1 or cut is not None:
                break
            # the lower corner's smaller eigenvalue bounds the least one from above: a first guess
            x, y, z = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            half = (x - y) / 2
            shift = max(0.0, y - z / (abs(half) + math.sqrt(half * half + z)) if half > 0 else min(x, y) - math.sqrt(z))
            for guess in (shift, None, 0.25 * shift, 0.0):
                guess = max(0.0, shift + least) * (1 - 4 * _EPS) if guess is None else guess
                nq, ne, least = _dqds(q, e, guess)
                if least >= 0 or guess == 0:
                    break
            q, e, moved = [max(x, 0.0) for x in nq], ne, moved + guess
        else:
            raise ArithmeticError("dqds did not settle")
        if len(q) == 1:
            out.append(moved + q[0])
        else:
            blocks.append((q[:cut + 1], e[:cut], moved))
            blocks.append((q[cut + 1:], e[cut + 1:], moved))
    return np.sort(np.array(out))[::-1] * size * size


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of B'B for ``value``, by a twisted factorisation."""
    n, tiny = len(a), float(np.finfo(float).tiny) * 1e20
    low, diag = b / a[:-1], a * a
    guard = lambda x: x if abs(x) > tiny else math.copysign(tiny, x)
    down, up = np.zeros(n - 1), np.zeros(n - 1)  # multipliers of the two factors
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        d = guard(s[i] + diag[i])
        down[i] = diag[i] * low[i] / d
        s[i + 1] = down[i] * low[i] * s[i] - value
    p[-1] = diag[-1] - value
    for i in range(n - 2, -1, -1):
        d = guard(diag[i] * low[i] ** 2 + p[i + 1])
        t = diag[i] / d
        up[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    k = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[k] = 1
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def eigenvectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, k: int, gap: float = 1e-3) -> np.ndarray:
    """Columns: orthonormal eigenvectors of B'B for the first ``k`` of ``values`` (falling)."""
    n = len(a)
    size = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0), np.finfo(float).tiny)
    a = np.where(np.abs(a) < _EPS * size, _EPS * size, a)  # L needs a diagonal
    big = np.diag(a) + np.diag(b, 1)
    square = big.T @ big
    rng = np.random.default_rng(12)
    out = np.zeros((n, k))
    first = 0
    for j, value in enumerate(values[:k]):
        if j and values[j - 1] - value > gap * values[j - 1]:
            first = j  # of the values close to this one
        z = _twisted(a, b, value)
        near = out[:, first:j]
        if j > first or (j + 1 < len(values) and value - values[j + 1] <= gap * value) or not np.isfinite(z).all():
            z = np.where(np.isfinite(z), z, 0)
            z -= near @ (near.T @ z)
            if np.linalg.norm(z) < 1e-3:
                z = rng.standard_normal(n)
            for turn in range(4):
                z -= near @ (near.T @ z)
                try:
                    off = value + _EPS * size ** 2 * (j - first + 1) * (2 + turn)  # near the value, hardly ever on it
                    z = np.linalg.solve(square - off * np.eye(n), z / np.linalg.norm(z))
                except np.linalg.LinAlgError:
                    pass
                z /= np.linalg.norm(z)
            for _ in range(2):
                z -= near @ (near.T @ z)
                z /= np.linalg.norm(z)
        out[:, j] = z
    return out


def principal(r: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, directions as columns, all eigenvalues) of r'r / n: the ``k`` largest with variance."""
    d = r.shape[1]
    if d == 0:
        return np.zeros(0), np.zeros((0, 0)), np.zeros(0)
    if d == 1:
        values, v = np.array([float(r[0, 0]) ** 2]), np.eye(1)
    else:
        a, b, v = bidiagonal(r)
        values = squared_values(a, b)
    k = min(k, int(((values > values.max(initial=0) * 1e-22) & (values > 0)).sum()))
    found = v @ (eigenvectors(a, b, values, k) if d > 1 else np.eye(1)[:, :k])
    if not k:
        return np.zeros(0), found, values / n
    largest = np.abs(found).argmax(axis=0)
    return values[:k] / n, found * np.sign(found[largest, np.arange(k)]), values / n


# ---------------------------------------------------------------- Spark

def _fold(parts: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """One value from the rows (node, data) of ``parts``, ``_FAN`` of them in a task at a time."""
    parts = materialize(parts, "whiten-parts")
    left = parts.count()
    while left > 1:
        def meet(group: pd.DataFrame) -> pd.DataFrame:
            rows = group.sort_values("node")
            return pd.DataFrame({"node": [int(rows["node"].iloc[0]) // _FAN], "data": [merge(list(rows["data"]))]})

        parts = materialize(parts.groupBy(F.floor(F.col("node") / _FAN).alias("to")).applyInPandas(
            lambda key, group: meet(group), "node long, data binary"), "whiten-parts")
        left = parts.count()
    row = parts.first()
    return None if row is None else bytes(row["data"])


def _task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _matrix(vectors: pd.Series, d: int) -> np.ndarray:
    out = np.full((len(vectors), d), OFFSET, np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _triangle(blocks: list[np.ndarray], d: int) -> np.ndarray:
    """The d x d triangular factor of the stacked blocks."""
    r = np.linalg.qr(np.vstack(blocks), mode="r")
    return np.vstack((r, np.zeros((max(0, d - len(r)), d))))


def _moments(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, mean and centred products of all rows, from those of parts."""
    n, mean, prod = parts[0]
    for m, other, more in parts[1:]:
        step = other - mean
        prod = prod + more + np.outer(step, step) * (n * m / (n + m))
        mean, n = mean + step * (m / (n + m)), n + m
    return n, mean, prod


def _deviations(centred: np.ndarray) -> list[int | None]:
    """Sums of squares of whole numbers, exact."""
    most = int(np.abs(centred).max(initial=0))
    if most * most * centred.shape[1] < 1 << 63:
        return (centred * centred).sum(axis=1).tolist()
    sums = [sum(int(c) * int(c) for c in row) for row in centred]
    return [s if s < 1 << 63 else None for s in sums]


def whiten(table: DataFrame, k: int = 16, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for
    every row with a usable vector and the first ``k`` components."""
    spark = table.sparkSession
    vec = F.col(vec_col)
    rows = table.filter(usable(vec)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vec, lambda c: F.floor(c.cast("double") * scale) + OFFSET).alias("x"))
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = materialize(rows.select("x").distinct(), "whiten-fit")
    size = fit.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = size["n"], size["d"] or 0
    if n == 0 or d == 0:
        return spark.createDataFrame([], out)

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = sum((_matrix(p["x"], d).sum(axis=0) for p in parts), np.zeros(d, np.int64))
        yield pd.DataFrame({"at": np.arange(d), "s": total})

    s = np.zeros(d, np.int64)
    for row in fit.mapInPandas(sums, "at int, s long").groupBy("at").agg(F.sum("s").alias("s")).collect():  # d rows
        s[row["at"]] = row["s"]
    centre = lambda vectors: n * _matrix(vectors, d) - s

    def factor(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = None
        for p in parts:
            if len(p):
                r = _triangle(([] if r is None else [r]) + [centre(p["x"]) / n], d)
        if r is not None:
            yield pd.DataFrame({"node": [_task()], "data": [r.tobytes()]})

    as_matrix = lambda data: np.frombuffer(data, float).reshape(d, d)
    r = as_matrix(_fold(fit.mapInPandas(factor, "node long, data binary"),
                        lambda found: _triangle([as_matrix(x) for x in found], d).tobytes()))
    values, directions, every = principal(r, n, k)
    if not len(values):
        return spark.createDataFrame([], out)
    onto = directions / np.sqrt(values)
    k = len(values)

    def moments(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = []
        for p in parts:
            if len(p):
                w = (centre(p["x"]) / n) @ onto
                mean = w.mean(axis=0)
                found.append((len(w), mean, (w - mean).T @ (w - mean)))
        if found:
            yield pd.DataFrame({"node": [_task()], "data": [_packed(_moments(found))]})

    def _packed(m: tuple[int, np.ndarray, np.ndarray]) -> bytes:
        return np.concatenate(([m[0]], m[1], m[2].ravel())).tobytes()

    def _unpacked(data: bytes) -> tuple[float, np.ndarray, np.ndarray]:
        x = np.frombuffer(data, float)
        return x[0], x[1:1 + k], x[1 + k:].reshape(k, k)

    whole = _unpacked(_fold(fit.mapInPandas(moments, "node long, data binary"),
                            lambda found: _packed(_moments([_unpacked(x) for x in found]))))
    error = float(np.abs(whole[2] / n - np.eye(k)).max())
    explained = (values / every.sum()).tolist()

    def project(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            c = centre(p["x"]) if len(p) else np.zeros((0, d), np.int64)
            yield pd.DataFrame({"id": p["id"], "none": p["none"], "deviation": pd.array(_deviations(c), "Int64"),
                                "w": pd.Series(list((c / n) @ onto), dtype=object, index=p.index)})

    # a null id in pandas would make the others doubles
    carried = rows.select(F.coalesce("vec_id", F.lit(0)).alias("id"), F.col("vec_id").isNull().alias("none"), "x")
    found = carried.mapInPandas(project, "id long, none boolean, deviation long, w array<double>").withColumn(
        "vec_id", F.when(~F.col("none"), F.col("id")))
    share = F.element_at(F.array(*[F.lit(x) for x in explained]), F.col("component"))
    return found.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).withColumn(
        "component", (F.col("at") + 1).cast("int")).select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"),
        F.lit(error).alias("identity_error"))
