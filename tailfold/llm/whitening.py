"""Whitening of vectors by principal components from a Jacobi-Davidson eigensolver.

The covariance is never formed: a product with it is one Spark pass that centres every vector before
multiplying and adds up ``C'(CU)``.  The solver keeps a search space of a few vectors on the driver
(dimensions x search space, nothing that grows with the rows).  Every round it takes the Ritz pairs
of the space, locks the leading ones whose residuals are down to double precision, and solves the
projected correction equations ``(I - QQ')(V - theta)(I - QQ') t = -r`` of the next ones by some steps
of MINRES, all corrections sharing each pass.  A full space restarts from its best Ritz vectors.

Defined results: rows whose vector is null or holds a null or non-finite entry take no part, and
neither do rows with an entry of 2**46 or more (``x`` would not be exact).  Vectors live in one space:
where lengths differ, rows of the most frequent length (ties: the longer) take part.  Components end
before the first without variance (a relative eigenvalue of ``FLAT`` or less), so constant tables and
tables of fewer vectors than components give fewer or no rows.  Ties of eigenvalues give some
orthonormal choice.  Repeated rows count as often as they come and come back as often.  A deviation
beyond a long is null.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tailfold.session import stage

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
#: Corrections that are solved at once.
BLOCK = 8
MINRES_STEPS = 8
#: Search space on top of the wanted components before it restarts.
ROOM = 3 * BLOCK
#: Residual norm over the largest eigenvalue.
PRECISION = 2.0 ** -44
FLAT = 1e-12
MAX_ROUNDS = 500
SEED = 11
_EXACT = float(1 << 46)


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column without nulls, as one double array, and their offsets."""
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return values, np.concatenate([[0], np.cumsum(lengths)])


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        batch = batch.filter(batch.column(1).is_valid())
        values, offsets = _vectors(batch.column(1))
        bad = ~(np.abs(values) < _EXACT)
        good = np.diff(np.concatenate([[0], np.cumsum(bad)])[offsets]) == 0
        lengths = np.diff(offsets)
        x = np.floor(SCALE * values[np.repeat(good, lengths)]).astype(np.int64) + SHIFT
        ends = np.concatenate([[0], np.cumsum(lengths[good])])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(pa.array(good)), pa.array(lengths[good], pa.int32()),
             pa.LargeListArray.from_arrays(pa.array(ends), pa.array(x)).cast(pa.list_(pa.int64()))],
            ["_id", "_size", "_x"])


def fit_list(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Staged ``_id, _x`` of the rows that take part, ``_x`` as longs."""
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = stage(
        vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_x"))
        .mapInArrow(_scaled, f"_id {id_type}, _size int, _x array<bigint>"), "whitening-vectors")
    size = rows.groupBy("_size").count().orderBy(F.desc("count"), F.desc("_size")).first()
    return rows.where(F.col("_size") == (size["_size"] if size else 0)).select("_id", "_x")


class Centre:
    """``n`` and the sums of every dimension, as exact integers; centres batches of ``_x``."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.dims = n, len(sums)
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def moved(self, column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), self.dims) - self.base

    def centred(self, column: pa.Array) -> np.ndarray:
        """``x - S / n`` in double precision, without cancellation."""
        return self.moved(column) - self.rest / self.n

    def deviations(self, column: pa.Array) -> list[int | None]:
        """Sum over dimensions of ``(n * x - S) ** 2``, exactly."""
        moved = self.moved(column)
        most = float(np.abs(moved).max(initial=0)) + 1
        if self.dims * (self.n * most) ** 2 < 2.0 ** 62:
            return ((self.n * moved - self.rest) ** 2).sum(1).tolist()
        exact = ((self.n * moved.astype(object) - self.rest.astype(object)) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def centre_of(rows: DataFrame) -> Centre | None:
    """The centre of staged rows; None without rows or dimensions."""
    sums = rows.select(F.posexplode("_x").alias("j", "x")).groupBy("j").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()
    if not sums:
        return None
    return Centre(sums[0]["n"], [int(r["s"]) for r in sorted(sums, key=lambda r: r["j"])])


def summed(rows: DataFrame, centre: Centre, shape: tuple[int, ...],
           function: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``function(centred batch)``, an array of ``shape``.

    Tasks add up their batches; the cells of their sums meet by number, so nothing but the result
    comes to the driver.
    """
    size = int(np.prod(shape))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += function(centre.centred(batch.column(0)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(total.ravel())], ["cell", "v"])

    out = np.zeros(size)
    cells = rows.select("_x").mapInArrow(added, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v"))
    for row in cells.collect():
        out[row["cell"]] = row["v"]
    return out.reshape(shape)


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric (maybe indefinite) systems, one a column, side by side."""
    def norm(a: np.ndarray) -> np.ndarray:
        return np.linalg.norm(a, axis=0)

    beta = norm(right)
    v, v_old = right / np.where(beta > 0, beta, 1), np.zeros_like(right)
    x, w, w_old = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    left = beta.copy()
    c, c_old = np.ones_like(beta), np.ones_like(beta)
    s, s_old = np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        u = product(v)
        alpha = (v * u).sum(0)
        u -= alpha * v + beta * v_old
        beta_new = norm(u)
        # the new column of the triangular factor of the Lanczos matrix
        far, near = s_old * beta, s * alpha + c_old * c * beta
        corner = c * alpha - c_old * s * beta
        diagonal = np.hypot(corner, beta_new)
        safe = np.where(diagonal > 0, diagonal, 1)
        c_old, s_old = c, s
        c, s = np.where(diagonal > 0, corner / safe, 1), np.where(diagonal > 0, beta_new / safe, 0)
        w, w_old = np.where(diagonal > 0, (v - far * w_old - near * w) / safe, 0), w
        x += c * left * w
        left = -s * left
        v, v_old = u / np.where(beta_new > 0, beta_new, 1), v
        beta = beta_new
    return x


def _orthonormal(new: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal ``others``."""
    for _ in range(2):
        for other in others:
            new = new - other @ (other.T @ new)
        size = np.linalg.norm(new, axis=0)
        new = new[:, size > 0] / size[size > 0]
        basis, values, _ = np.linalg.svd(new, full_matrices=False)
        new = basis[:, values > 1e-8]
    return new


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], dims: int,
                  wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their eigenvectors, to double precision (Jacobi-Davidson).

    ``product`` multiplies a block of columns by a symmetric matrix without negative eigenvalues.
    """
    wanted = min(wanted, dims)
    rng = np.random.default_rng(SEED)
    basis = _orthonormal(rng.standard_normal((dims, min(dims, wanted + BLOCK))))
    image = product(basis)
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    for _ in range(MAX_ROUNDS):
        theta, turn = np.linalg.eigh(basis.T @ image)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        rest = image - basis * theta
        rest -= locked @ (locked.T @ rest)
        size = np.linalg.norm(rest, axis=0)
        most = max(values.max(initial=0), theta.max(initial=0))
        whole = locked.shape[1] + basis.shape[1] == dims  # nothing is left to search
        done = 0
        while len(values) + done < wanted and done < len(theta) and (
                whole or size[done] <= PRECISION * most):
            done += 1
        locked, values = np.hstack([locked, basis[:, :done]]), np.concatenate([values, theta[:done]])
        basis, image, theta, rest = basis[:, done:], image[:, done:], theta[done:], rest[:, done:]
        if len(values) == wanted:
            break
        open_ = wanted - len(values)
        size = size[done:]
        block = [i for i in range(min(open_ + 1, len(theta))) if size[i] > PRECISION * most][:BLOCK]
        near = basis[:, :open_ + 1]
        shift = theta[block]

        def projected(t: np.ndarray) -> np.ndarray:
            for q in (locked, near):
                t = t - q @ (q.T @ t)
            return t

        corrections = minres(
            lambda t: projected(product(t) - t * shift), projected(-rest[:, block]), MINRES_STEPS)
        if basis.shape[1] + len(block) > open_ + ROOM:
            basis, image = basis[:, :open_ + BLOCK], image[:, :open_ + BLOCK]
        new = _orthonormal(corrections, locked, basis)
        if not new.shape[1]:
            new = _orthonormal(rng.standard_normal((dims, BLOCK)), locked, basis)
        basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    else:
        raise ArithmeticError(f"eigenvectors did not settle in {MAX_ROUNDS} rounds")
    # once more in the space of the locked vectors, from a fresh product
    locked = np.linalg.qr(locked)[0]
    image = product(locked)
    theta, turn = np.linalg.eigh(locked.T @ image)
    vectors = (locked @ turn)[:, ::-1]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return theta[::-1].copy(), vectors * sign


def whitened(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """Every row and component: id, ``component, n, deviation, whitened, explained, identity_error``."""
    rows = fit_list(vectors, id_col, vec_col)
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = (f"_id {id_type}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    centre = centre_of(rows)
    if centre is None:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("_id", id_col)
    n, dims = centre.n, centre.dims

    def product(u: np.ndarray) -> np.ndarray:
        return summed(rows, centre, u.shape, lambda c: c.T @ (c @ u)) / n

    total = float(summed(rows, centre, (1,), lambda c: np.array([(c * c).sum()]))[0]) / n
    values, directions = leading_pairs(product, dims, components) if total > 0 else (
        np.zeros(0), np.zeros((dims, 0)))
    kept = int((values > FLAT * values.max(initial=0)).sum())
    values, directions = values[:kept], directions[:, :kept]
    scaled = directions / np.sqrt(values)

    def moments(c: np.ndarray) -> np.ndarray:
        w = c @ scaled
        return np.vstack([w.T @ w, w.sum(0)])

    found = summed(rows, centre, (kept + 1, kept), moments) / n if kept else np.zeros((1, 0))
    covariance = found[:-1] - np.outer(found[-1], found[-1])
    error = float(np.abs(covariance - np.eye(kept)).max(initial=0))
    explained = values / total if kept else values

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not kept:
                continue
            w = centre.centred(batch.column(1)) @ scaled
            at = np.repeat(np.arange(batch.num_rows), kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)),
                 pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), batch.num_rows)),
                 pa.array(np.full(len(at), n, np.int64)),
                 pa.array(centre.deviations(batch.column(1)), pa.int64()).take(pa.array(at)),
                 pa.array(w.ravel()), pa.array(np.tile(explained, batch.num_rows)),
                 pa.array(np.full(len(at), error))],
                ["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(written, schema).withColumnRenamed("_id", id_col)
