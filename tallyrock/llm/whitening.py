"""Whitening of embeddings by their leading principal components, found by the Jacobi-Davidson method.

An embedding's entries become whole numbers x = floor(256 c), and each distinct x vector is one row
of the fit list. Its covariance matrix V (divisor n) is never formed: a pass over the fit list
multiplies it with a few vectors at once, each task centring its rows by the exact mean
before it multiplies. The solver on the driver holds vectors of the embeddings' dimension only. It
takes the best approximations in a subspace (Rayleigh-Ritz), locks those whose residual has
come down to double precision, solves the projected correction equation of each other one by some
steps of MINRES, which share their passes, and adds the corrections to the subspace, which is cut back to
its best vectors when it grows.

Rows are dropped whose vector is NULL, holds a NULL, NaN or infinite entry, or has another
length than most rows that are left have (of two equally frequent lengths the longer counts). An entry beyond the
range of a long takes its end. Components whose eigenvalue is 0, to rounding, are not given: there are fewer than
four where the distinct vectors span fewer dimensions, and no rows where all vectors are
equal, or where there are none. A deviation beyond the range of a long is NULL. Repeated rows,
and rows without an id, give rows of their own. The sign of a component is that which makes its largest entry
positive. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyrock.llm.common import read, written

COMPONENTS = 4
SPARE = 2  # more vectors than components at the start and after a restart
SUBSPACE = 24  # vectors at which the subspace is cut back
INNER = 8  # steps of MINRES for a correction
OUTER = 200  # corrections after which the solver gives up
BLOCK = 4096  # vectors in a row of the fit list
SLICE = 1024  # vectors worked on at a time
SCALE = 256.0


def usable(vector: str) -> Column:
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.col(vector).isNotNull() & F.forall(vector, entry)


def whole(vector: str) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(SCALE)) + F.lit(0).cast("long"))


def dimension_of(rows: DataFrame) -> int:
    """The most frequent length of x: the lengths that occur are counted by Spark, one row is taken."""
    lengths = rows.groupBy(F.size("x").alias("d")).count()
    found = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return 0 if found is None else found["d"]


def packed(distinct: DataFrame) -> DataFrame:
    """(rows, x): up to BLOCK vectors as the bytes of the narrowest whole numbers that hold them."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, BLOCK):
                piece = part.slice(start, BLOCK)
                x = piece.column(0).flatten().to_numpy().reshape(piece.num_rows, -1)
                kind = next(k for k in (np.int16, np.int32, np.int64) if x.min() >= np.iinfo(k).min and x.max() <= np.iinfo(k).max)
                raw = x.astype(kind).tobytes()
                columns = [pa.array([piece.num_rows], pa.int32()), pa.array([np.dtype(kind).itemsize], pa.int32()), pa.array([raw])]
                yield pa.RecordBatch.from_arrays(columns, ["rows", "width", "x"])

    return distinct.select("x").mapInArrow(work, "rows int, width int, x binary")


def vectors_of(part: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The vectors of some rows of the fit list, as longs, SLICE at a time."""
    for rows, width, raw in zip(*(c.to_pylist() for c in part.columns)):
        x = np.frombuffer(raw, f"<i{width}").reshape(rows, -1)
        for start in range(0, rows, SLICE):
            yield x[start : start + SLICE].astype(np.int64)


def totals(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """The number of vectors, and their exact sums per dimension."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Halves of 32 bits, since a sum of longs may not be one.
        high, low, n = np.zeros(dimension, np.int64), np.zeros(dimension, np.int64), 0
        for part in parts:
            for x in vectors_of(part):
                high, low, n = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0), n + len(x)
        columns = [np.arange(dimension), high, low, np.full(dimension, n)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["i", "high", "low", "n"])

    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]
    found = fit.mapInArrow(work, "i long, high long, low long, n long").groupBy("i").agg(*sums).orderBy("i").collect()
    if not found:
        return 0, [0] * dimension
    return int(found[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in found]


@dataclass
class Centred:
    """The fit list with its exact mean: what its covariance matrix does to vectors, pass by pass."""

    fit: DataFrame
    n: int
    sums: list[int]
    passes: int = 0

    def __post_init__(self):
        self.mean = np.array([s / self.n for s in self.sums])

    def summed(self, work: Callable[[np.ndarray], np.ndarray], rows: int, columns: int) -> np.ndarray:
        """The sum over the fit list of what `work` makes of centred vectors: a matrix of bounded size.

        Tasks add up their own vectors; Spark adds up the tasks, row by row of the matrix.
        """
        mean, names = self.mean, [f"c{k}" for k in range(columns)]

        def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((rows, columns))
            for part in parts:
                for x in vectors_of(part):
                    total += work(x - mean)
            found = [pa.array(np.arange(rows))] + [pa.array(total[:, k]) for k in range(columns)]
            yield pa.RecordBatch.from_arrays(found, ["i", *names])

        self.passes += 1
        partial = self.fit.mapInArrow(task, ", ".join(["i long", *(f"{c} double" for c in names)]))
        found = partial.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).toArrow().sort_by("i")
        return np.column_stack([found[c].to_numpy() for c in names])

    def times(self, vectors: np.ndarray) -> np.ndarray:
        """V times the columns."""
        return self.summed(lambda x: x.T @ (x @ vectors), *vectors.shape) / self.n

    def trace(self) -> float:
        return float(self.summed(lambda x: (x * x).sum(axis=0)[:, None], len(self.mean), 1).sum()) / self.n

    def identity_error(self, projection: np.ndarray) -> float:
        """How far the covariance of the projected vectors is from the identity, in any entry."""
        k = projection.shape[1]

        def work(x: np.ndarray) -> np.ndarray:
            w = x @ projection
            return np.column_stack([w.T @ w, w.sum(axis=0)])

        found = self.summed(work, k, k + 1) / self.n
        mean = found[:, k]
        return float(np.abs(found[:, :k] - np.outer(mean, mean) - np.eye(k)).max())


def orthonormal(vectors: np.ndarray, against: np.ndarray) -> np.ndarray:
    """What the columns add to an orthonormal basis; columns that add nothing are left out."""
    kept = against
    for v in vectors.T:
        size = np.linalg.norm(v)
        if size == 0 or not np.isfinite(size):
            continue
        v = v / size
        for _ in range(3):
            v = v - kept @ (kept.T @ v)
            size = np.linalg.norm(v)
            if size < 1e-10:
                break
            v = v / size
        if size >= 1e-10:
            kept = np.column_stack([kept, v])
    return kept[:, against.shape[1] :]


def corrections(times: Callable, values: np.ndarray, basis: np.ndarray, residuals: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions t of P (V - value) P t = -residual, a column each; P takes out the basis.

    MINRES runs on all columns in step, so that a step is one pass over the data.
    """

    def project(v: np.ndarray) -> np.ndarray:
        v = v - basis @ (basis.T @ v)
        return v - basis @ (basis.T @ v)

    r = project(-residuals)
    k = r.shape[1]
    beta = np.linalg.norm(r, axis=0)
    safe = lambda x: np.where(np.abs(x) > 0, x, 1.0)
    v, v_old = r / safe(beta), np.zeros_like(r)
    t, w, w_old = np.zeros_like(r), np.zeros_like(r), np.zeros_like(r)
    eta, cos, cos_old, sin, sin_old = beta.copy(), np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    beta_k, going = np.zeros(k), beta > 0
    for _ in range(steps):
        if not going.any():
            break
        p = project(times(v) - v * values) - beta_k * v_old
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v
        beta_next = np.linalg.norm(p, axis=0)
        delta = cos * alpha - cos_old * sin * beta_k
        rho = np.hypot(delta, beta_next)
        rho_2, rho_3 = sin * alpha + cos_old * cos * beta_k, sin_old * beta_k
        cos_old, sin_old = cos, sin
        cos, sin = delta / safe(rho), beta_next / safe(rho)
        w_old, w = w, (v - rho_3 * w_old - rho_2 * w) / safe(rho)
        going = going & (rho > 0)
        t = t + np.where(going, cos * eta, 0.0) * w
        eta = -sin * eta
        v_old, v, beta_k = v, p / safe(beta_next), beta_next
        going = going & (beta_next > 1e-14 * np.abs(values))
    return t


def jacobi_davidson(times: Callable, dimension: int, wanted: int, most: int = SUBSPACE) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors, of the symmetric matrix behind `times`.

    A residual counts as nothing at dimension x the unit roundoff of the largest eigenvalue.
    """
    wanted = min(wanted, dimension)
    block = min(wanted + SPARE, dimension)
    most = max(most, 2 * block)
    locked, values = np.zeros((dimension, 0)), []
    start = np.random.default_rng(7).standard_normal((dimension, block))
    space = orthonormal(times(start), np.zeros((dimension, 0)))
    if space.shape[1] < block:  # the matrix has no more rank than that
        wanted = min(wanted, space.shape[1])
    if wanted == 0:
        return np.zeros(0), locked
    images = times(space)
    for _ in range(OUTER):
        found, turn = np.linalg.eigh((space.T @ images + images.T @ space) / 2)
        found, turn = found[::-1], turn[:, ::-1]
        ritz, moved = space @ turn, images @ turn
        largest = max([*values, found[0]])
        limit = max(dimension, 16) * np.finfo(float).eps * largest
        open_ = min(wanted - len(values), len(found))
        residuals = moved[:, :open_] - ritz[:, :open_] * found[:open_]
        residuals = residuals - locked @ (locked.T @ residuals)
        small = np.linalg.norm(residuals, axis=0) <= limit
        # Only from the top, so that what is locked are the largest ones.
        done = int(np.argmin(small)) if not small.all() else len(small)
        if done:
            locked = np.column_stack([locked, ritz[:, :done]])
            values += found[:done].tolist()
        if len(values) == wanted:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        left = slice(done, open_)
        keep = ritz.shape[1] if ritz.shape[1] < most else done + wanted - len(values) + SPARE
        space, images = ritz[:, done:keep], moved[:, done:keep]
        worked = ~small[left]
        basis = orthonormal(ritz[:, left], locked)
        basis = np.column_stack([locked, basis])
        new = corrections(times, found[left][worked], basis, residuals[:, left][:, worked], INNER)
        new = orthonormal(new, np.column_stack([locked, space]))
        if not new.shape[1]:
            # Nothing to correct: what the subspace lacks is looked for elsewhere.
            new = np.random.default_rng(len(values)).standard_normal((dimension, 1))
            new = orthonormal(new, np.column_stack([locked, space]))
        if new.shape[1]:
            space, images = np.column_stack([space, new]), np.column_stack([images, times(new)])
    raise ArithmeticError(f"residuals did not come down to {limit} in {OUTER} corrections")


def exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of squares of n x - S per vector; None where that is no long."""
    top = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if x.shape[1] * top * top < 1 << 63:
        apart = n * x - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = n * x.astype(object) - np.array(sums, object)
    return [int(s) if s < 1 << 63 else None for s in (apart * apart).sum(axis=1)]


@dataclass
class Whitening:
    """What whitening vectors takes: their number and sums, components, eigenvalues and the check of both."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that are not dropped for their entries."""
    rows = embeddings.select("vec_id", "embedding").where(usable("embedding"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole("embedding").alias("x"))


def fitted(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening | None:
    """Fits to the distinct vectors of that dimension; None where nothing varies."""
    distinct = rows.where(F.size("x") == dimension).select("x").distinct()
    fit = written(packed(distinct), "fit-list")
    n, sums = totals(fit, dimension)
    if n < 2:
        return None
    centred = Centred(fit, n, sums)
    trace = centred.trace()
    values, vectors = jacobi_davidson(centred.times, dimension, components)
    real = values > max(dimension, 16) * np.finfo(float).eps * trace
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return None
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return Whitening(n, sums, values, vectors, trace, centred.identity_error(vectors / np.sqrt(values)))


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: SCHEMA."""
    rows = whole_vectors(embeddings)
    dimension = dimension_of(rows)
    model = fitted(rows, dimension, components) if dimension else None
    if model is None:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    mean, projection = np.array([s / model.n for s in model.sums]), model.projection
    explained, k = model.values / model.trace, len(model.values)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, part.num_rows, SLICE):
                piece = part.slice(start, SLICE)
                m = piece.num_rows
                x = piece.column(1).flatten().to_numpy().reshape(m, dimension)
                columns = [
                    pa.array(np.repeat(piece.column(0).to_pylist(), k).tolist(), pa.int64()),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n), pa.int64()),
                    pa.array([d for d in exact_deviations(x, model.n, model.sums) for _ in range(k)], pa.int64()),
                    pa.array(((x - mean) @ projection).reshape(-1)),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    return rows.where(F.size("x") == dimension).mapInArrow(work, SCHEMA)


def op13_jacobi_davidson(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(read(spark, folder, "embeddings", "vec_id", "embedding"))
