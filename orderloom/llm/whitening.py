"""PCA whitening of embeddings by the Jacobi-Davidson method.

The leading eigenpairs of the covariance matrix are found matrix-free: the
driver holds a few vectors of the embedding's dimension, and every product
with the covariance is a distributed pass over the rows, centred before it is
multiplied, with partial sums per task that Spark adds up.

Each outer step projects the covariance on the subspace (Rayleigh-Ritz), locks
the leading Ritz pairs whose residuals have reached double precision, and
widens the subspace by corrections for the others: the projected correction
equations ``(I - QQ')(A - theta I)(I - QQ') t = -r``, Q being the locked and
the wanted Ritz vectors, are solved by a few steps of MINRES, all equations at
once, so one pass serves all of them.  A subspace grown too wide restarts from
its best Ritz vectors.  It ends when all wanted pairs are locked.

Defined results: a vector that is null or holds null or non-finite entries is
left out, like one with an entry of 2^53 / 1024 or more in size (it has no
exact integer) and one whose length is not the most frequent (ties: the
longest); null ids and repeated rows stay; components of no variance (at most
``RANK`` of the largest) cannot be whitened and have no rows, so one vector, or
copies of one, gives none, and an empty table gives none.  A ``deviation``
beyond a bigint is null.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut, prepare

Block = Callable[[np.ndarray], np.ndarray]

SCALE, SHIFT = 1024, 100_000
PART_BYTES = 16 << 20    # integers of one partition of the fit list
PRECISION = 32 * np.finfo(np.float64).eps    # of a residual, in the largest eigenvalue
ROUNDING = 1e-11         # a residual that stands still under this is as small as rounding lets it be
RANK = 1e-12
INNER, WIDTH, SEED = 8, 5, 42   # MINRES steps; widest subspace, in wanted pairs; start block


def minres(apply: Block, rhs: np.ndarray, steps: int, rel: float) -> np.ndarray:
    """Solutions of a symmetric system for each column of ``rhs``, at most
    ``steps`` products, until residuals are ``rel`` of the start."""
    beta = np.linalg.norm(rhs, axis=0)
    start, live = beta.copy(), beta > 0
    safe = lambda x: np.where(x == 0, 1.0, x)
    v, v_old = rhs / safe(beta), np.zeros_like(rhs)
    w = w_old = x = np.zeros_like(rhs)
    c = c_old = np.ones_like(beta)
    s = s_old = np.zeros_like(beta)
    eta = beta.copy()
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        after = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        r1 = np.hypot(delta, after)
        r2 = s * alpha + c_old * c * beta
        r3 = s_old * beta
        live = live & (r1 > 0)
        c_old, c = c, np.where(live, delta / safe(r1), 1.0)
        s_old, s = s, np.where(live, after / safe(r1), 0.0)
        w_old, w = w, np.where(live, (v - r3 * w_old - r2 * w) / safe(r1), 0.0)
        x = x + np.where(live, c * eta, 0.0) * w
        eta = -s * eta
        v_old, v, beta = v, p / safe(after), after
        live = live & (after > 0) & (np.abs(eta) > rel * start)
        if not live.any():
            break
    return x


def orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns of what ``block`` adds to ``basis``."""
    norms = np.linalg.norm(block, axis=0)
    block = block[:, norms > 0] / norms[norms > 0]
    for _ in range(3):
        block = block - basis @ (basis.T @ block)
        q, r = np.linalg.qr(block)
        block = q[:, np.abs(np.diag(r)) > 1e-10]
        if not block.shape[1]:
            break
    return block


def jacobi_davidson(apply: Block, dims: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of
    the symmetric positive matrix behind ``apply`` (products with a block)."""
    k = min(wanted, dims)
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    start = np.random.default_rng(SEED).standard_normal((dims, min(dims, 2 * k)))
    basis = orthonormal(start, locked)
    image = apply(basis)
    largest, before, outer = 0.0, np.inf, 0
    while True:
        outer += 1
        h = basis.T @ image
        theta, turn = np.linalg.eigh((h + h.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        largest = max(largest, *np.abs(theta), *np.abs(values))
        want = min(k - len(values), len(theta))
        res = image[:, :want] - basis[:, :want] * theta[:want]
        res -= locked @ (locked.T @ res)
        size = np.linalg.norm(res, axis=0)
        full = len(values) + basis.shape[1] >= dims
        still = outer > 2 and size[0] <= ROUNDING * largest and size[0] > before / 2
        good = (size <= PRECISION * largest) | full
        done = want if good.all() else int(good.argmin())
        if not done and still:
            done = 1
        before = size[done] if done < want else np.inf
        locked = np.hstack([locked, basis[:, :done]])
        values = np.append(values, theta[:done])
        basis, image, theta, res = basis[:, done:], image[:, done:], theta[done:], res[:, done:]
        want -= done
        if len(values) == k:
            break
        if basis.shape[1] + want > WIDTH * k:
            basis, image = basis[:, :2 * k], image[:, :2 * k]
        held = np.hstack([locked, basis[:, :want]])

        def project(x: np.ndarray, held: np.ndarray = held) -> np.ndarray:
            x = x - held @ (held.T @ x)
            return x - held @ (held.T @ x)

        def shifted(x: np.ndarray, theta: np.ndarray = theta[:want]) -> np.ndarray:
            x = project(x)
            return project(apply(x) - x * theta)

        # Later equations are solved more exactly; in the end steps reach the dimension.
        t = minres(shifted, -project(res), min(dims, INNER * max(1, outer // 4)), 0.5 ** (2 + 2 * outer))
        fresh = orthonormal(project(t), np.hstack([locked, basis]))
        if not fresh.shape[1]:               # nothing new: a random direction
            more = np.random.default_rng(SEED + outer).standard_normal((dims, want))
            fresh = orthonormal(more, np.hstack([locked, basis]))
        basis, image = np.hstack([basis, fresh]), np.hstack([image, apply(fresh)])
    order = np.argsort(-values, kind="stable")
    return values[order], locked[:, order]


def matrix(b: pa.RecordBatch, dims: int) -> np.ndarray:
    return b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def summed(fit: DataFrame, dims: int, f: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum over all rows of ``f(block of integer vectors)``, an array."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = None
        for b in batches:
            if b.num_rows:
                got = f(matrix(b, dims)).ravel()
                acc = got if acc is None else acc + got
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array([acc.tolist()], pa.list_(
                pa.int64() if kind == "bigint" else pa.float64()))], names=["v"])

    got = (fit.select("x").mapInArrow(part, f"v array<{kind}>").select(F.posexplode("v"))
           .groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect())
    return np.array([r["s"] for r in got])


def integers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, x)``: the scaled vectors; see the module for what is left out."""
    vector = F.col(vector_col)
    near = F.forall(vector, lambda e: F.abs(e.cast("double") * SCALE) < float(1 << 53))
    return rows.where(near).select(F.col(id_col).alias("id"), F.transform(
        vector, lambda e: F.floor(e.cast("double") * SCALE) + SHIFT).alias("x"))


def whiten(rows: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding"
           ) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``
    for every vector and component; see ``op13`` for their meaning."""
    prepare(rows.sparkSession)
    ints = integers(rows, id_col, vector_col)
    lengths = ints.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    n, dims = (lengths["count"], lengths["dims"]) if lengths else (0, 0)
    parts = max(1, -(-n * dims * 8 // PART_BYTES))
    fit = cut(ints.where(F.size("x") == dims).repartition(parts))
    kind = fit.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    sums = [int(s) for s in summed(fit, dims, lambda x: x.sum(axis=0), "bigint")] if dims else []
    if not sums:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    mean = np.array([s / n for s in sums])

    def product(block: np.ndarray) -> np.ndarray:
        def f(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ block)
        return summed(fit, dims, f).reshape(dims, -1) / n

    trace = float(summed(fit, dims, lambda x: ((x - mean) ** 2).sum(axis=0)).sum()) / n
    values, vectors = jacobi_davidson(product, dims, components)
    ok = values > RANK * max(values[0], 0.0)
    values, vectors = values[ok], vectors[:, ok]
    if not len(values):
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    top = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[top, np.arange(len(values))])
    to_white = vectors / np.sqrt(values)
    k = len(values)
    white_mean = summed(fit, dims, lambda x: ((x - mean) @ to_white).sum(axis=0)) / n

    def cross(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ to_white - white_mean
        return y.T @ y
    error = float(np.abs(summed(fit, dims, cross).reshape(k, k) / n - np.eye(k)).max())

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b, dims)
            white = (x - mean) @ to_white
            off = np.abs(n * x.astype(np.float64) - np.array(sums, np.float64)).max(initial=0)
            if off < 2 ** 53 and dims * off ** 2 < 2 ** 62:
                deviation = pa.array(((n * x - np.array(sums)) ** 2).sum(axis=1))
            else:                            # as integers of any size
                exact = [sum((n * e - s) ** 2 for e, s in zip(row, sums)) for row in x.tolist()]
                deviation = pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
            take = pa.array(np.repeat(np.arange(len(x)), k))
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), deviation.take(take), pa.array(white.ravel()),
                 pa.array(np.tile(values / trace, m)), pa.array(np.full(m * k, error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fit.mapInArrow(told, schema).withColumnRenamed("id", id_col)
