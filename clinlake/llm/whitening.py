"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation (operator 11).

The n rows, centred by their exact means, are a tall matrix X that is only ever
multiplied: alternating products X v and X' u build orthonormal v's and u's with
X V = U B, B upper bidiagonal. The singular vectors of the small B give the
principal components (V W) and its singular values the deviations (sigma / sqrt n).

One pass over the data serves both products of a step. A long vector u is never
stored: u_j = X p_j for a vector p_j of row length, so every task recomputes its
rows' entries of the u's from the p's it was sent, multiplies its block of
X (v_j - beta p_{j-1}) into X' u, and sums the inner products with all earlier
u's, by which the new one is reorthogonalised in full. Tasks send d + j + 1
numbers, which Spark adds up; the driver holds vectors of row length (at most
2 d of them) and reorthogonalises the v's among themselves.

The iteration ends early only if the wanted triplets have converged against
their gaps and the variance not yet found is too small for another component of
their size to be hidden in it (equal deviations show in a Krylov space only
once); otherwise it runs for all d steps, with a fresh orthogonal start wherever
a step breaks down. Both ends are exact to rounding.

Defined results: vectors that are null or hold null or non-finite entries are
dropped. All vectors must have one length to share a covariance: those whose
length is not the most frequent one (ties: the shortest) take no part, nor do
empty ones. Entries are whole numbers floor(SCALE c) + SHIFT, held to +-2**62.
Components without variance (beyond the rank of the data, or all of them if the
rows are equal) cannot be whitened and have no rows. ``deviation`` is null where
the exact number exceeds 64 bits. Rows without id and repeated rows are rows
like others; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinlake.llm.common import materialize, show_package, table

COMPONENTS = 8
SCALE, SHIFT = 1024.0, 100_000
#: Wanted triplets have converged when their residuals are this small against their gaps.
CONVERGED = 1e-13
#: An inner product with an earlier u above this share of the new one asks for a second pass.
ORTHOGONAL = 1e-9
LIMIT = float(1 << 62)


def whole_numbers(vector: Column) -> Column:
    """Entries floor(SCALE c) + SHIFT as longs; null unless all are finite."""
    def whole(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))) + SHIFT

    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(vector, whole))


def _block(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The rows' whole numbers as an n x d matrix."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)


def _total(rows: DataFrame, d: int, block_sums: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """``block_sums`` of all rows' matrices added up: tasks add their batches, Spark the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            if batch.num_rows:
                sums = block_sums(_block(batch, d))
                own = sums if own is None else own + sums
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own), dtype="int32")), pa.array(own)], ["pos", "value"])

    value = F.col("value").cast("decimal(19,0)") if kind == "long" else F.col("value")
    sums = rows.select("x").mapInArrow(run, f"pos int, value {kind}").groupBy("pos").agg(F.sum(value).alias("value"))
    found = {r["pos"]: r["value"] for r in sums.collect()}  # as many as block_sums has numbers
    return [found[i] for i in range(len(found))]


def exact_sums(rows: DataFrame, d: int) -> list[int]:
    """The sum of every dimension (high and low halves, so that tasks cannot overflow)."""
    halves = [int(s) for s in _total(rows, d, lambda m: np.concatenate([(m >> 32).sum(0), (m & 0xFFFFFFFF).sum(0)]), "long")]
    return [(high << 32) + low for high, low in zip(halves[:d], halves[d:])]


@dataclass
class Fit:
    """Components (columns), their eigenvalues, the trace, means, sums and rows."""

    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    mean: np.ndarray
    sums: list[int]
    n: int
    steps: int = 0


def _orthogonal(w: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for v in basis:
            w = w - (v @ w) * v
    return w


def _converged(alpha: list[float], beta: list[float], wanted: int, whole: float) -> bool:
    """Whether the wanted triplets of the steps so far stand, and none can be hidden."""
    left, sigma, _ = np.linalg.svd(np.diag(alpha) + np.diag(beta[:-1], 1))
    if len(sigma) <= wanted:
        return False
    residual = beta[-1] * np.abs(left[-1, :wanted])
    gaps = -np.diff(sigma[:wanted + 1])
    gaps = np.minimum(gaps, np.concatenate([[np.inf], gaps[:-1]]))
    hidden = whole * (1 + 1e-12) - (sigma**2).sum()
    return bool((residual <= CONVERGED * gaps).all() and hidden < sigma[wanted - 1] ** 2)


def bidiagonalise(product: Callable, d: int, wanted: int, whole: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray, int]:
    """(right singular vectors as columns, singular values, steps) of X, largest first.

    ``product(q, p)`` gives (X p)' X q, |X q|^2 and X' X q; ``whole`` is |X|_F^2."""
    random = np.random.Generator(np.random.PCG64(seed))
    tiny = d * np.finfo(float).eps * np.sqrt(whole)
    start = random.standard_normal(d)
    v, p, xu = [start / np.linalg.norm(start)], [], []
    alpha, beta = [], []
    while True:
        q = v[-1] - beta[-1] * p[-1] if beta else v[-1]
        for _ in range(3):  # what is not orthogonal after that is rounding
            inner, size, back = product(q, p)
            for c, own, other in zip(inner, p, xu):
                q, back = q - c * own, back - c * other
            removed = float(inner @ inner)
            settled = removed <= ORTHOGONAL**2 * size
            if settled or size <= tiny**2:
                break
        alpha.append(float(np.sqrt(max(size - removed, 0.0))) if settled else 0.0)
        if alpha[-1] <= tiny:
            alpha[-1] = 0.0
        p.append(q / alpha[-1] if alpha[-1] else np.zeros(d))
        xu.append(back / alpha[-1] if alpha[-1] else np.zeros(d))
        w = _orthogonal(xu[-1] - alpha[-1] * v[-1], v)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= tiny:
            beta[-1] = 0.0
        if len(v) == d or (len(v) > wanted and _converged(alpha, beta, wanted, whole)):
            break
        while not beta[-1]:  # a fresh start, orthogonal to all so far
            w = _orthogonal(random.standard_normal(d), v)
            if np.linalg.norm(w) > 1e-8:
                break
        v.append(_orthogonal(w / np.linalg.norm(w), v))
        v[-1] /= np.linalg.norm(v[-1])
    _, sigma, right = np.linalg.svd(np.diag(alpha) + np.diag(beta[:-1], 1))
    return np.stack(v, 1) @ right.T, sigma, len(v)


def fit(rows: DataFrame, n: int, d: int, components: int = COMPONENTS) -> Fit:
    """The leading components of written ``rows`` (x: d longs, not null)."""
    sums = exact_sums(rows, d)
    mean = np.array([s / n for s in sums])

    def squares(m: np.ndarray) -> np.ndarray:
        return np.array([((m - mean) ** 2).sum()])

    def product(q: np.ndarray, p: list[np.ndarray]) -> tuple[np.ndarray, float, np.ndarray]:
        earlier, k = np.stack(p, 1) if p else np.zeros((d, 0)), len(p)

        def block_sums(m: np.ndarray) -> np.ndarray:
            x = m - mean
            u = x @ q
            return np.concatenate([(x @ earlier).T @ u, [u @ u], x.T @ u])

        out = np.array(_total(rows, d, block_sums))
        return out[:k], float(out[k]), out[k + 1:]

    whole = float(_total(rows, d, squares)[0])
    wanted = min(components, d)
    if not whole:
        return Fit(np.zeros((d, 0)), np.zeros(0), 0.0, mean, sums, n)
    vectors, sigma, steps = bidiagonalise(product, d, wanted, whole)
    kept = [i for i in range(min(wanted, len(sigma))) if sigma[i] > d * np.finfo(float).eps * sigma[0]]
    vectors = vectors[:, kept]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), range(len(kept))])
    return Fit(vectors * signs, sigma[kept] ** 2 / n, whole / n, mean, sums, n, steps)


def _whiten(own: Fit, m: np.ndarray) -> np.ndarray:
    return ((m - own.mean) @ own.components) / np.sqrt(own.eigenvalues)


def identity_error(rows: DataFrame, own: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    d, k = len(own.mean), len(own.eigenvalues)
    middle = np.array(_total(rows, d, lambda m: _whiten(own, m).sum(0))) / own.n

    def products(m: np.ndarray) -> np.ndarray:
        w = _whiten(own, m) - middle
        return (w.T @ w).ravel()

    covariance = np.array(_total(rows, d, products)).reshape(k, k) / own.n
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(m: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums over the dimensions of (n x - S)^2; None beyond 64 bits."""
    most = int(np.abs(m).max(initial=0)) * n + max(map(abs, sums), default=0)
    if most < 1 << 62:
        z = m * n - np.array(sums, "int64")
        if int(np.abs(z).max(initial=0)) ** 2 * max(1, m.shape[1]) < 1 << 62:
            return (z * z).sum(1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in m.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for every vector and component: vec_id, component (from 1), n, deviation,
    whitened, explained and identity_error. ``vectors`` has vec_id and x (longs, or null)."""
    spark = vectors.sparkSession
    vectors = materialize(vectors.filter("x is not null").select("vec_id", "x"), "whitening-vectors")
    lengths = vectors.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("d > 0")
    common = lengths.orderBy(F.desc("n"), "d").first()
    if common is None:
        return spark.createDataFrame([], _OUT)
    d, n = common["d"], common["n"]
    rows = vectors.filter(F.size("x") == d)
    own = fit(rows, n, d, components)
    k = len(own.eigenvalues)
    if not k:
        return spark.createDataFrame([], _OUT)
    error = identity_error(rows, own)
    explained = own.eigenvalues / own.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, count = _block(batch, d), batch.num_rows
            each = pa.array(np.repeat(np.arange(count), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype="int32"), count)),
                pa.array(np.full(count * k, n)), pa.array(_deviations(m, n, own.sums), pa.int64()).take(each),
                pa.array(_whiten(own, m).ravel()), pa.array(np.tile(explained, count)), pa.array(np.full(count * k, error)),
            ], [c.split()[0] for c in _OUT.split(", ")])

    return rows.mapInArrow(run, _OUT)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings`` on the eight leading components."""
    show_package(spark)
    rows = table(spark, sf_dir, "embeddings")
    return whiten(rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding")).alias("x")))
