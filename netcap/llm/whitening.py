"""Operator 12 - embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers, x = floor(64 c) + 1,000,000. With n fitted rows and
exact sums S per dimension, a row is centred as (n x - S) / n, whose numerator is
computed in whole numbers: nothing cancels. Of the centred matrix X

    X V = U B,   X' U = V B'   (B upper bidiagonal)

is built a column at a time. One pass over the rows takes the driver's v and gives p = X v;
the tasks add up X'p, U'p and p'p, one number per dimension and column. From these come
alpha and u = (p - U U'p) / alpha, then beta and the next v, orthogonalised fully (and
twice) against all before; a second pass with the corrected direction does the same for
u, when the first one lost digits. No u is stored: each lies in the columns' space, u = X w,
and its w, as long as a vector, stays on the driver, so the tasks recompute the rows of
U as X W. Where beta vanishes a new direction is taken, orthogonal to all before, so
equal deviations are found too. All steps are done, as many as there are dimensions
(``steps`` ends earlier, for the largest components alone).

The singular values s of the small B give eigenvalues s^2 / n, its right vectors,
times V, the components. A last pass adds up the covariance of the whitened rows.
The driver holds matrices of dimensions x steps, the tasks get the same; rows stay where
they are, nothing is shuffled but partial sums.

Defined results: rows with a null vector, or with null or non-finite entries, take no
part; nor do vectors shorter than the longest (empty ones too). A null id is kept, repeated
rows all count. Dimensions without deviation are no components: eigenvalues below
``NOISE`` of the largest are left out, so one row, or equal rows, give no rows; an
empty table neither. Equal eigenvalues: some orthonormal basis. ``deviation`` is null where
it exceeds a long. Extra columns are ignored. Entries times 64 have to fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netcap.llm.common import written
from netcap.llm.topk_search import quantised

SHIFT = 1_000_000
COMPONENTS = 32
NOISE = 1e-13        # of the largest eigenvalue
LOST = 1e-2          # of a direction's length left by orthogonalising: then it is done again
VANISHED = 1e-10     # of the largest alpha or beta

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, "
          "explained double, identity_error double")


def finite(vector: Column) -> Column:
    big = F.lit(float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)), F.lit(False))


def fit_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, x (longs) of the rows that take part."""
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
            .filter(finite(F.col("v")) & (F.size("v") > 0)))
    x = F.transform(quantised(F.col("v")), lambda c: c + F.lit(SHIFT))
    rows = written(vectors.sparkSession, rows.select("vec_id", x.alias("x")), "op12-rows")
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    return rows.filter(F.size("x") == F.lit(longest or 0))


def matrix(b: pa.RecordBatch) -> np.ndarray:
    x = b.column(b.schema.get_field_index("x"))
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


@dataclass
class Centre:
    """n and S: what rows are centred by, in whole numbers as long as they fit."""

    n: int
    sums: np.ndarray          # Python integers
    reach: int                # largest absolute entry

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        if 2 * self.n * max(self.reach, 1) < 1 << 63:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S / n."""
        return self.numerators(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over the dimensions of (n x - S)^2; None where one exceeds a long."""
        d = self.numerators(x)
        most = int(max(np.abs(d).max(initial=0), 1))
        if most * most * d.shape[1] < 1 << 63:
            return (d.astype(np.int64) ** 2).sum(axis=1).tolist()
        found = [sum(int(v) ** 2 for v in row) for row in d]
        return [v if v < 1 << 63 else None for v in found]


def centre(rows: DataFrame) -> Centre:
    """From one row per dimension."""
    each = (rows.select(F.posexplode("x").alias("i", "v")).groupBy("i")
            .agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"),
                 F.max(F.abs("v")).alias("reach")).collect())
    by = {r["i"]: r for r in each}
    return Centre(each[0]["n"] if each else 0,
                  np.array([int(by[i]["s"]) for i in range(len(by))], object),
                  max((r["reach"] for r in each), default=0))


def added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sums over all rows of ``part``: batch of rows -> ``size`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(size), False
        for b in batches:
            total, any_rows = total + part(matrix(b)), True
        if any_rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "v"])

    out = np.zeros(size)
    for r in (rows.select("x").mapInArrow(run, "i int, v double").groupBy("i")
              .agg(F.sum("v").alias("v")).collect()):
        out[r["i"]] = r["v"]
    return out


def against(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``v`` without its parts along the columns of ``basis``, taken off twice."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


@dataclass
class Bidiagonal:
    """V, the coefficients W of U = X W, and B's diagonals."""

    v: np.ndarray
    w: np.ndarray
    alpha: np.ndarray
    beta: np.ndarray

    def components(self, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Columns and eigenvalues, falling."""
        b = np.diag(self.alpha) + np.diag(self.beta[:len(self.alpha) - 1], 1)
        _, s, right = np.linalg.svd(b)
        e = s ** 2 / n
        keep = np.flatnonzero(e > NOISE * max(e[0], 1e-300))[:most]
        return self.v @ right[keep].T, e[keep]


def products(rows: DataFrame, about: Centre, w: np.ndarray, v: np.ndarray) -> tuple:
    """X'p, U'p and p'p of p = X v, for U = X w: one pass."""
    d, k = len(v), w.shape[1]

    def part(x: np.ndarray) -> np.ndarray:
        x = about.rows(x)
        p = x @ v
        return np.concatenate([x.T @ p, (x @ w).T @ p, [p @ p]])

    got = added(rows, part, d + k + 1)
    return got[:d], got[d:d + k], got[-1]


def bidiagonalise(rows: DataFrame, about: Centre, steps: int | None = None,
                  seed: int = 12) -> Bidiagonal:
    d = len(about.sums)
    steps = min(steps or d, d)
    rng = np.random.default_rng(seed)
    vs, ws, xu = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    alpha, beta = [], []
    v, scale = against(rng.standard_normal(d), vs), 0.0
    v /= np.linalg.norm(v)
    for _ in range(steps):
        vs = np.column_stack([vs, v])
        at, xp, off, pp = v, *products(rows, about, ws, v)
        for again in (True, False):
            # p less its parts along U; by Pythagoras its length is known before u is.
            at, xp = at - ws @ off, xp - xu @ off
            left = pp - off @ off
            if not again or left > LOST * pp:
                break
            xp, off, pp = products(rows, about, ws, at)
        size = np.sqrt(max(left, 0.0))
        scale = max(scale, size)
        gone = size <= VANISHED * scale
        # A vanished u stands for no direction; its column of B is zero.
        w, u_back = (np.zeros(d), np.zeros(d)) if gone else (at / size, xp / size)
        alpha.append(0.0 if gone else size)
        ws, xu = np.column_stack([ws, w]), np.column_stack([xu, u_back])
        if vs.shape[1] == steps:
            break
        v = against(u_back - (0.0 if gone else size) * v, vs)
        size = np.linalg.norm(v)
        if size <= VANISHED * scale:   # the space is used up: another direction
            v, size = against(rng.standard_normal(d), vs), 0.0
        beta.append(size)
        v = v / np.linalg.norm(v)
        v = against(v, vs)
        v /= np.linalg.norm(v)
    return Bidiagonal(vs, ws, np.array(alpha), np.array(beta))


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding", steps: int | None = None) -> DataFrame:
    """One row per row that takes part and component: the result's columns."""
    rows = fit_rows(vectors, id_col, vec_col)
    about = centre(rows)
    if not about.n:
        return vectors.sparkSession.createDataFrame([], RESULT)
    total = added(rows, lambda x: np.array([(about.rows(x) ** 2).sum()]), 1)[0] / about.n
    found, e = (bidiagonalise(rows, about, steps).components(about.n, components) if total > 0
                else (np.zeros((len(about.sums), 0)), np.zeros(0)))
    k = len(e)
    by = found / np.sqrt(e)

    def spread(x: np.ndarray) -> np.ndarray:
        y = about.rows(x) @ by
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0)])

    sums = added(rows, spread, k * k + k) / about.n
    mean = sums[k * k:]
    covariance = sums[:k * k].reshape(k, k) - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(k)).max(initial=0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RESULT.split(", ")]
        for b in batches:
            x, m = matrix(b), b.num_rows
            y = about.rows(x) @ by
            ids = b.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
            deviation = pa.array(about.deviations(x), pa.int64()).take(
                pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, about.n, np.int64)), deviation, pa.array(y.ravel()),
                 pa.array(np.tile(e / total, m)), pa.array(np.full(m * k, error))], names)

    return rows.select("vec_id", "x").mapInArrow(run, RESULT)
