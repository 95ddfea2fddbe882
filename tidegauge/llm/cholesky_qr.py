"""Whitening components of embeddings by shifted CholeskyQR over Spark.

The centred rows A (one per vector, in whole units of 1/1024) are never gathered: every pass over the table adds up a Gram
matrix, d x d for d dimensions, whatever the number of rows.

1. G = A'A. Its Cholesky factor R1, of G plus a small multiple of the identity (the shift), exists even where A is badly
   conditioned. Q = A inv(R1), by solving triangular systems row block by row block.
2. The next pass sums Q'Q, factors it to R2, and so on, until Q'Q is the identity to working precision: two more passes
   as a rule. Then A = Q R with R = ... R2 R1.
3. R is d x d: its singular values are those of A, its right singular vectors the components.

Columns of Q that stay dependent (constant dimensions, fewer vectors than dimensions) never become orthonormal. So R is
multiplied by the square root of the last Q'Q before its SVD, which changes nothing where that is the identity.

A pass adds up matrices per task; tasks' matrices are added ``FAN`` at a time, in a fixed order, and only the last few reach
the driver. What is broadcast are the factors, d x d numbers each.

Rows: a null vector, or one with a null or non-finite entry, is left out, so is one with an entry of 2**52 or more either way
(1024 times that is no 64-bit number) and one whose length is not the commonest (the longest of equally common ones). Null or equal ids: every row is a vector of its own. Fewer than d + 1 vectors, or none: components
without variance have null ``whitened``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024.0, 100_000
LIMIT = float(1 << 52)
FAN = 64
#: Vectors worked on at a time.
ROWS = 4096


def valid_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>): the rows that have a vector (see the module)."""
    v = F.col("v")
    rows = vectors.select("vec_id", F.col(column).cast("array<double>").alias("v"))
    rows = rows.where(v.isNotNull() & F.forall(v, lambda c: F.coalesce(F.abs(c) < LIMIT, F.lit(False))))
    sizes = rows.groupBy(F.size("v").alias("size")).count()
    common = sizes.agg(F.max(F.struct("count", "size")).alias("top")).select(F.col("top.size").alias("d")).first()
    return rows.where(F.size("v") == (common.d if common.d is not None else 0))


def whole_numbers(column: pa.Array) -> np.ndarray:
    """x of every vector, one row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(flat * SCALE).astype(np.int64) + OFFSET).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, whole_numbers(part.column("v"))


@dataclass
class Centre:
    """Number and exact sums of the whole-number vectors."""

    n: int
    sums: list[int]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly; as Python numbers where 64 bits might not do."""
        largest = self.n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, self.sums)) if x.size else 0
        if largest < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean."""
        return (self.scaled(x) / self.n).astype(float)


def _exact_sums(rows: DataFrame) -> Centre:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for _, x in _blocks(batches):
            narrow = max(abs(int(x.min())), abs(int(x.max()))) * len(x) < 1 << 62
            part = (x if narrow else x.astype(object)).sum(axis=0).astype(object)
            sums = part if sums is None else sums + part
            n += len(x)
        if n:
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([n], pa.int64()), "sums": pa.array([sums.tolist()], pa.list_(pa.decimal128(38)))
            })

    parts = rows.select("v").mapInArrow(add, "n long, sums array<decimal(38,0)>")
    found = parts.select("n", F.posexplode("sums")).groupBy("pos").agg(F.sum("n").alias("n"), F.sum("col").alias("s"))
    found = sorted((r.pos, r.n, int(r.s)) for r in found.collect())  # a row per dimension
    return Centre(found[0][1] if found else 0, [s for _, _, s in found])


def summed(rows: DataFrame, matrix: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``matrix(x)`` over blocks of whole-number vectors."""
    schema = "part int, data binary"

    def batch(part: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "data": pa.array([total.tobytes()], pa.binary())})

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for _, x in _blocks(batches):
            one = matrix(x)
            total = one if total is None else total + one
        if total is not None:
            yield batch(TaskContext.get().partitionId(), total)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for found in batches:
            for data in found.column("data"):
                one = np.frombuffer(data.as_buffer(), np.float64)
                total = one if total is None else total + one
            part = found.column("part")[0].as_py() // FAN
        if total is not None:
            yield batch(part, total)

    sums, count = rows.select("v").mapInArrow(first, schema), rows.rdd.getNumPartitions()
    while count > FAN:
        group = F.floor(F.col("part") / FAN)
        count = -(-count // FAN)
        sums = sums.repartitionByRange(count, group).sortWithinPartitions("part").mapInArrow(again, schema)
    parts = [np.frombuffer(r.data, np.float64) for r in sorted(sums.collect(), key=lambda r: r.part)]
    return np.sum(parts, axis=0)


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows inv(factor) for an upper triangular factor, by substitution from the left."""
    out = np.empty_like(rows)
    for j in range(factor.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def upper_factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """R with R'R = gram plus a shift: that which makes a factor sure to exist, and none unless asked for or needed."""
    d = gram.shape[0]
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.trace(gram)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


@dataclass
class Components:
    """Unit eigenvectors of the covariance as columns, their eigenvalues, and the covariance's trace."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def transform(self) -> np.ndarray:
        """Columns that take centred rows to whitened ones; zero for components without variance."""
        some = self.values > 0
        return np.where(some, self.vectors / np.sqrt(np.where(some, self.values, 1.0)), 0.0)


def fit(rows: DataFrame) -> Components | None:
    """Components of ``valid_vectors`` rows by shifted CholeskyQR; None for an empty table."""
    centre = _exact_sums(rows)
    d, n = len(centre.sums), centre.n
    if not n or not d:
        return None
    context, factors, whole, trace, apart = rows.sparkSession.sparkContext, [], np.eye(d), 0.0, np.inf
    while True:
        shared = context.broadcast(factors)

        def gram(x: np.ndarray, shared=shared) -> np.ndarray:
            q = centre.rows(x)
            for factor in shared.value:
                q = solved(q, factor)
            return q.T @ q

        found = summed(rows, gram).reshape(d, d)
        before, apart = apart, np.abs(found - np.eye(d)).max()
        if not factors:
            trace = float(np.trace(found)) / n
        # Orthonormal to working precision, or no nearer than before: what is left are columns without variance.
        if not trace or (factors and apart < d * 1e-14) or (len(factors) > 2 and apart > before / 2):
            break
        factors = [*factors, upper_factor(found, n, shifted=not factors)]
        whole = factors[-1] @ whole
    values, vectors = np.linalg.eigh(found)
    _, sizes, right = np.linalg.svd(np.sqrt(np.maximum(values, 0))[:, None] * vectors.T @ whole)
    eigen = sizes**2 / n
    eigen[eigen <= eigen[0] * d * n * np.finfo(float).eps ** 2 * 16] = 0.0
    return Components(centre, right.T, eigen if trace else np.zeros(d), trace)


def whitened(vectors: DataFrame, components: int = 8, column: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: vec_id, component (from 1, by falling variance), n, deviation (sum of
    (n x - S)**2, null beyond 64 bits), whitened, explained (share of the variance) and identity_error (largest entry of the
    whitened covariance minus the identity, over components that have variance).

    All vectors go through the same transform, so a component has one sign everywhere.
    """
    rows = valid_vectors(vectors, column)
    kind = dict(vectors.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = min(components, len(model.values))
    centre, n = model.centre, model.centre.n
    shared = rows.sparkSession.sparkContext.broadcast((model.transform()[:, :k], model.values[:k]))
    mean = summed(rows, lambda x: (centre.rows(x) @ shared.value[0]).sum(axis=0)) / n

    def outer(x: np.ndarray) -> np.ndarray:
        w = centre.rows(x) @ shared.value[0] - mean
        return w.T @ w

    wanted = np.diag((model.values[:k] > 0).astype(float))
    error = float(np.abs(summed(rows, outer).reshape(k, k) / n - wanted).max()) if k else 0.0
    explained = model.values[:k] / model.trace if model.trace else np.full(k, np.nan)

    def rows_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transform, values = shared.value
        for batch, x in _blocks(batches):
            exact = centre.scaled(x)
            narrow = exact.dtype != object and np.abs(exact.astype(float)).max(initial=0) ** 2 * exact.shape[1] < 2.0**62
            squares = (exact * exact).sum(axis=1) if narrow else [sum(int(e) ** 2 for e in row) for row in exact]
            squares = pa.array([s if s < 1 << 63 else None for s in map(int, squares)], pa.int64())
            every = np.repeat(np.arange(batch.num_rows), k)
            score = centre.rows(x) @ transform
            score[:, values <= 0] = np.nan
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(every)),
                    pa.array(np.tile(np.arange(1, k + 1), batch.num_rows), pa.int32()),
                    pa.array(np.full(len(every), n), pa.int64()),
                    squares.take(pa.array(every)),
                    pa.array(score.ravel(), pa.float64(), from_pandas=True),
                    pa.array(np.tile(explained, batch.num_rows), pa.float64(), from_pandas=True),
                    pa.array(np.full(len(every), error), pa.float64()),
                ],
                schema.replace(",", "").split(" ")[::2],
            )

    return rows.mapInArrow(rows_out, schema)
