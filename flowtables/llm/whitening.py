"""Whitening of vectors by shifted CholeskyQR.

The n x d matrix of centred rows is never gathered. A Gram pass adds up d x d
products per task; its Cholesky factor R turns rows into nearly orthonormal ones
through a triangular solve, in the next pass, inside the tasks. The first factor is
of the Gram matrix plus a small shift, so it exists for ill-conditioned rows too;
two more passes bring the rows to orthonormality in double precision. The product
of the factors is the R of the whole matrix, and its SVD gives the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from flowtables.llm.common import id_text, ship_functions, stored, with_id

SCALE, OFFSET = 1024, 100_000
PASSES = 3


def whole_numbers(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id (text), x (array of long): floor(1024 * c) + 100000 of each entry c; rows of another length than the commonest go."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    entries = F.transform(F.col(vector), lambda c: c.cast("double"))
    rows = vectors.select(id_text(id_column).alias("id"), entries.alias("e")).where(F.size("e") > 0).where(F.forall("e", finite))
    rows = rows.select("id", F.transform("e", lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x"))
    rows = stored(rows, "vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1)
    found = lengths.first()
    return rows.where(F.size("x") == (found["d"] if found else 0))


def _matrix(frame: pd.DataFrame) -> np.ndarray:
    return np.stack(frame["x"].to_numpy()).astype(np.int64)


def _added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind: str = "double") -> np.ndarray:
    """Sum of ``part`` over all batches: added up in each task, then entry by entry by Spark. The driver gets one array of ``shape``."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if len(frame):
                here = part(_matrix(frame))
                total = here if total is None else total + here
        if total is not None:
            yield pd.DataFrame({"at": np.arange(total.size), "v": total.ravel()})

    out = np.zeros(int(np.prod(shape)), np.int64 if kind == "long" else np.float64)
    for r in rows.mapInPandas(work, f"at long, v {kind}").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out.reshape(shape)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n; the difference is taken in whole numbers."""
    return (n * x - sums) / n


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverse of each upper triangular factor in turn, column by column."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(r.shape[1]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def components(rows: DataFrame, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) of the covariance of ``rows`` and its unit eigenvectors, as columns.

    Directions without variance are left out: if the first Gram matrix is singular to
    double precision, rows are first taken to an orthonormal basis of its range.
    """
    d = len(sums)
    basis, factors = np.eye(d), []
    for step in range(PASSES):
        chosen, done = basis, list(factors)

        def part(x: np.ndarray, chosen: np.ndarray = chosen, done: list = done) -> np.ndarray:
            q = solved(centred(x, n, sums) @ chosen, done)
            return q.T @ q

        gram = _added(rows, part, (chosen.shape[1], chosen.shape[1]))
        gram = (gram + gram.T) / 2
        if step == 0:
            values, vectors = np.linalg.eigh(gram)
            held = values > max(values.max(), 0.0) * d * 1e-15 * 16
            if not held.any():
                return np.empty(0), np.empty((d, 0))
            if not held.all():
                basis = vectors[:, held]
                gram = np.diag(values[held])
            size = len(gram)
            gram = gram + np.eye(size) * (11 * (n * size + size * (size + 1)) * 2.0**-53 * np.linalg.norm(gram, 2))
        factors.append(np.linalg.cholesky(gram).T)
    whole = factors[0]
    for r in factors[1:]:
        whole = r @ whole
    _, singular, right = np.linalg.svd(whole)
    return singular**2 / n, basis @ right.T


def whitened(vectors: DataFrame, count: int = 8, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per vector and component.

    Vectors become whole numbers x = floor(1024 * c) + 100000; n are all vectors that
    remain, S their sums. ``deviation`` is the sum over dimensions of (n * x - S) ** 2, null where
    that is no long. ``whitened`` is x - S / n on a component, over the root of its eigenvalue;
    ``explained`` the eigenvalue's share of the variance; ``identity_error`` the largest absolute
    entry of the whitened rows' covariance less the identity.

    Null and empty vectors, those with null or non-finite entries, and those of another length
    than the commonest (of equally common ones the longest) are dropped. There are as many components as
    directions with variance, at most ``count``: none for equal rows, one row or an empty table. Rows that
    repeat an id, or have none, all count. Other columns are ignored. The driver holds d x d numbers.
    """
    rows = whole_numbers(vectors, id_column, vector)
    schema = f"{id_column} string, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n = rows.count()
    d = len(rows.first()["x"]) if n else 0
    sums = _added(rows, lambda x: x.sum(axis=0), (d,), "long") if n else np.zeros(0, np.int64)
    values, right = components(rows, n, sums) if n else (np.empty(0), np.empty((0, 0)))
    if not len(values):
        return with_id(rows.sparkSession.createDataFrame([], schema), id_column)
    k = min(count, len(values))
    to_white = right[:, :k] / np.sqrt(values[:k])
    share = values[:k] / values.sum()
    mean = _added(rows, lambda x: (centred(x, n, sums) @ to_white).sum(axis=0), (k,)) / n

    def squares(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ to_white - mean
        return w.T @ w

    error = float(np.abs(_added(rows, squares, (k, k)) / n - np.eye(k)).max())

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            x = _matrix(frame)
            apart = n * x - sums
            exact = (apart.astype(object) ** 2).sum(axis=1) if np.abs(apart).max() > 3e9 / np.sqrt(d) else (apart**2).sum(axis=1)
            deviation = pd.array([int(v) if v < 2**63 else None for v in exact], dtype="Int64")
            white = (apart / n) @ to_white
            yield pd.DataFrame({
                id_column: np.repeat(frame["id"].to_numpy(), k), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), "n": n,
                "deviation": deviation.repeat(k), "whitened": white.ravel(), "explained": np.tile(share, len(x)), "identity_error": error})

    return with_id(rows.mapInPandas(project, schema), id_column)


ship_functions(__name__)
