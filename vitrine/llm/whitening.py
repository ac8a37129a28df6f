"""Whitening of embeddings by their leading principal components, found with a block Jacobi-Davidson method.

Vectors become integers x = floor(scale * c) + shift, so that counts, sums and deviations are exact. The covariance V is never
formed: all that is asked of the data is the product of V with a few columns at once, a pass over the stored vectors in
which each task centres its rows, multiplies, and sends one small block, summed by Spark. Each round solves the
projected eigenproblem of a small search space, locks leading pairs whose residual has reached double precision, and widens the
space by approximate solutions of the correction equations (I - UU')(V - e I)(I - UU') t = -r, got by a few steps of MINRES for all
pairs in step, one pass each. Beyond `SPACE` columns the space restarts from its best ones. Only blocks as long as a vector has
entries reach the driver.

Defined cases: rows whose vector is null, empty, holds a null or non-finite entry or one too large for an exact integer, or has another length than most vectors
(of equally frequent lengths the largest) take no part and are not returned. Every remaining row, repeated ones and ones without an id too, gives one
row for each component. Components without variance (equal vectors, or fewer independent ones than components) are left out, since no division can whiten
them; an empty table gives an empty one. Among equal eigenvalues any orthonormal choice of components is right. A deviation that no long holds is null.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vitrine.llm.rows import importable
from vitrine.workspace import stage

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Columns the search space may have before it restarts, columns beside the wanted ones, and MINRES steps a round.
SPACE, GUARD, STEPS, ROUNDS = 96, 4, 4, 200
LARGEST = float(1 << 52)
EPS = float(np.finfo(float).eps)

Product = Callable[[np.ndarray], np.ndarray]


def integers(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """A written table (vec_id, x) of the vectors that take part."""
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    fits = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < LARGEST, F.lit(False)))  # false for NaN, too
    good = vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(fits)
    rows = stage(good.select(F.col(vec_id).alias("vec_id"), F.transform(scaled, lambda c: c + shift).alias("x")), "vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("x") == (lengths[0]["d"] if lengths else 0))


class Centred:
    """Sums and products over the written vectors. Everything it returns is as long as a vector, or a few times that."""

    def __init__(self, rows: DataFrame):
        importable(rows.sparkSession)
        self.rows = rows
        sums = rows.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum("c").alias("s"), F.count("*").alias("n")).collect()
        self.n = sums[0]["n"] if sums else 0
        self.sums = np.array([r["s"] for r in sorted(sums, key=lambda r: r["at"])], np.int64)
        self.passes = 0

    def summed(self, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all rows of what `work` makes of a block of centred rows, as one flat array."""
        n, sums = self.n, self.sums

        def run(batches):
            total = None
            for batch in batches:
                part = work(centred(matrix(batch.column("x"), len(sums)), n, sums)).ravel()
                total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["at", "v"])

        self.passes += 1
        found = self.rows.select("x").mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
        return np.array([r["v"] for r in sorted(found, key=lambda r: r["at"])])

    def covariance_times(self, z: np.ndarray) -> np.ndarray:
        return self.summed(lambda c: c.T @ (c @ z)).reshape(z.shape) / self.n

    def variance(self) -> float:
        return float(self.summed(lambda c: np.array([(c * c).sum()]))[0] / self.n)


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, rounded once: whole and rest of the mean are taken off one after the other."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def _orthonormal(t: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of t add to an orthonormal block; columns that add nothing go."""
    kept = []
    for k in range(t.shape[1]):
        v = t[:, k] / max(np.linalg.norm(t[:, k]), 1e-300)
        for _ in range(3):
            for basis in (against, np.column_stack(kept) if kept else None):
                if basis is not None and basis.shape[1]:
                    v = v - basis @ (basis.T @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v /= size
        else:
            kept.append(v)
    return np.column_stack(kept) if kept else np.empty((len(t), 0))


def corrections(product: Product, u: np.ndarray, values: np.ndarray, residuals: np.ndarray, steps: int) -> np.ndarray:
    """`steps` of MINRES for (I - uu')(V - e I)(I - uu') t = -r, one column for each value e, all columns by the same products.

    u: orthonormal columns that the solutions stay away from.
    """

    def clear(block):
        return block - u @ (u.T @ block)

    b = clear(clear(-residuals))
    beta = np.linalg.norm(b, axis=0)
    safe = lambda x: np.where(np.abs(x) > 1e-300, x, 1.0)
    v, v_old = b / safe(beta), np.zeros_like(b)
    t, d, d_old = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    c, c_old, s, s_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    eta, live, off = beta.copy(), beta > 0, beta * 0
    for _ in range(steps):
        w = clear(clear(product(v)) - v * values) - v_old * off
        alpha = (v * w).sum(0)
        w = clear(w - v * alpha)
        off_new = np.linalg.norm(w, axis=0)
        # two Givens rotations of the columns' tridiagonal matrices, then a new one
        low = s_old * off
        mid = c_old * off
        r2 = c * mid + s * alpha
        r1 = c * alpha - s * mid
        r0 = np.sqrt(r1 * r1 + off_new * off_new)
        c_old, s_old = c, s
        c, s = np.where(r0 > 0, r1 / safe(r0), 1.0), np.where(r0 > 0, off_new / safe(r0), 0.0)
        d, d_old = (v - d * r2 - d_old * low) / safe(r0), d
        t = t + np.where(live, c * eta, 0.0) * d
        eta = -s * eta
        live = live & (off_new > 1e-14 * np.abs(values).max())
        v, v_old, off = w / safe(off_new), v, off_new
        if not live.any():
            break
    return clear(t)


def leading(product: Product, d: int, wanted: int = COMPONENTS, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues (falling), their unit vectors and the norms of the residuals, for a symmetric product of size d."""
    wanted = min(wanted, d)
    locked, values = np.empty((d, 0)), np.empty(0)
    q = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, wanted + GUARD))), locked)
    w = product(q)
    for _ in range(ROUNDS):
        missing = wanted - locked.shape[1]
        h = q.T @ w
        e, s = np.linalg.eigh((h + h.T) / 2)
        e, s = e[::-1], s[:, ::-1]
        q, w = q @ s, w @ s
        residuals = w - q * e
        norms = np.linalg.norm(residuals, axis=0)
        most = max([abs(e[0]) if len(e) else 0.0, *np.abs(values)])
        done = norms <= 8 * np.sqrt(d) * EPS * most
        ready = 0
        while ready < min(missing, len(e)) and done[ready]:
            ready += 1
        locked, values = np.hstack([locked, q[:, :ready]]), np.r_[values, e[:ready]]
        q, w, e, residuals, missing = q[:, ready:], w[:, ready:], e[ready:], residuals[:, ready:], missing - ready
        if missing == 0:
            break
        if q.shape[1] + missing + GUARD > SPACE:
            keep = SPACE // 3
            q, w, e, residuals = q[:, :keep], w[:, :keep], e[:keep], residuals[:, :keep]
        k = min(missing + GUARD, q.shape[1])
        u = np.hstack([locked, q[:, :k]])
        t = corrections(product, u, e[:k], residuals[:, :k], STEPS)
        new = _orthonormal(np.hstack([t, residuals[:, :k]]) if t.shape[1] < 2 else t, np.hstack([locked, q]))
        if not new.shape[1]:  # the space is whole, or the residuals are as small as rounding lets them be
            new = _orthonormal(np.random.default_rng(seed + q.shape[1]).standard_normal((d, k)), np.hstack([locked, q]))
        if not new.shape[1]:
            w = product(q)  # nothing left to add: the space is all there is, and only rounding of the products remains
            locked, values = np.hstack([locked, q[:, :missing]]), np.r_[values, (q * w).sum(0)[:missing]]
            break
        q, w = np.hstack([q, new]), np.hstack([w, product(new)])
    order = np.argsort(-values, kind="stable")
    vectors, values = locked[:, order], values[order]
    last = product(vectors)
    values = (vectors * last).sum(0)
    norms = np.linalg.norm(last - vectors * values, axis=0)
    if vectors.shape[1] < wanted or (norms > 1e-11 * max(values[0], 0) + 1e-300).any():
        raise ArithmeticError(f"residuals {norms} of {vectors.shape[1]} pairs, not at double precision")
    return values, vectors, norms


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """For each row the exact sum of (n * x - sums) squared; null where no long holds it."""
    far = n * x.astype(float) - sums
    rough = (far * far).sum(1)
    if (rough < 2.0**62).all():
        exact = n * x - sums
        return pa.array((exact * exact).sum(1))
    total = [sum((n * a - s) ** 2 for a, s in zip(row, sums.tolist())) for row in x.tolist()]
    return pa.array([v if v < 1 << 63 else None for v in total], pa.int64())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), one row for each vector and component."""
    rows = integers(vectors, vec_id, vector)
    kind = rows.schema["vec_id"].dataType
    schema = T.StructType([
        T.StructField("vec_id", kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ])
    data = Centred(rows)
    spread = data.variance() if data.n else 0.0
    if not spread:
        return rows.sparkSession.createDataFrame([], schema)
    values, axes, _ = leading(data.covariance_times, len(data.sums), components)
    some = values > len(data.sums) * 1e-14 * values[0]
    values, axes = values[some], axes[:, some]
    k, n, sums = len(values), data.n, data.sums
    project = axes / np.sqrt(values)
    moments = data.summed(lambda c: np.vstack([(c @ project).sum(0), (c @ project).T @ (c @ project)])).reshape(k + 1, k) / n
    error = float(np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(k)).max())
    explained = values / spread
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("x"), len(sums))
            if not len(x):
                continue
            each = pa.array(np.repeat(np.arange(len(x)), k))
            m = len(x) * k
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(m, n, np.int64)),
                deviations(x, n, sums).take(each), pa.array((centred(x, n, sums) @ project).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error)),
            ], schema=arrow)

    return rows.mapInArrow(run, schema)
