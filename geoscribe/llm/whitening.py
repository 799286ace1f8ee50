"""Embedding whitening by shifted CholeskyQR.

Vectors are quantised to long ``x = floor(256 * c)``.  The fit list is each
distinct x vector once (n of them, sums S per dimension); its centred rows
``x - S / n``, computed as ``(n * x - S) / n`` with an exact numerator, are the
tall matrix A.

A pass over the fit list multiplies every block of rows by the inverses of the
R factors so far (triangular solves) and adds up its Gram matrix.  The driver
takes the Cholesky factor of the sum, shifted by a bound of its rounding error
so that it exists for any A, and the next pass goes on with it.  Two or three
passes make the columns orthonormal to the last bits; what then differs from the
identity goes into a last symmetric factor (which also serves columns without
variance), the factors compose to R, and the singular values and vectors of R
are those of A: ``e = s * s / n`` with components accurate to the condition of
A, not of its square.

On Spark each task holds one block of rows and one d x d sum.  The tasks' sums
are merged in a tree of at most ``FAN`` per task, in a fixed order, so that the
driver gets one d x d matrix a pass and reruns agree.  d is the length of a
vector, the only bound assumed.

Rows whose vector is null or holds null or non-finite entries, or entries beyond
the range of long, are dropped, and so are vectors that have not the most frequent
length (the longer of equals).  Repeated vectors count once in the fit and are
all returned; null and repeated ids are rows like any other.  Directions without
variance have no component, so a table of one distinct vector, like an empty
one, yields no rows.  ``deviation`` is null where it passes the range of long
(``deviation_exact`` has it as a decimal).  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscribe.llm import common
from geoscribe.sources.tables import table

SCALE = 256
COMPONENTS = 4
FAN = 32
MAX_PASSES = 8
LONG_MAX = (1 << 63) - 1
#: Singular values below this part of the largest are no variance but rounding.
NO_VARIANCE = 1e-10
EPS = np.finfo(float).eps


def quantised(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, x)``: whole, finite vectors as longs."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    # Null entries make forall null, NaN is above every number, and 2^55 * 256 is the range of long.
    whole = F.coalesce(F.forall("v", lambda c: F.abs(c) < float(1 << 55)), F.lit(False))
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long"))
    rows = rows.where(F.col("v").isNotNull() & whole).select("id", x.alias("x"))
    width = (rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
             .select(F.max(F.struct("n", "d"))["d"]).scalar())
    return rows.where(F.size("x") == width)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


@dataclass
class Moments:
    """Exact count, sums and largest entry of the fit list."""

    n: int
    sums: list[int]
    largest: int

    @property
    def small(self) -> bool:
        """Whether ``n * x - S`` fits in a long."""
        return 2 * self.n * max(self.largest, 1) <= LONG_MAX

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact."""
        if self.small:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(float) / self.n


def moments(fit: DataFrame) -> Moments | None:
    """Counts and sums: one row per task and dimension, added as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, largest, n = None, 0, 0
        for batch in batches:
            x = _matrix(batch)
            if not len(x):
                continue
            n += len(x)
            top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
            largest = max(largest, top)
            part = x.sum(axis=0) if top * len(x) <= LONG_MAX else x.astype(object).sum(axis=0)
            sums = [int(a) + b for a, b in zip(part, sums or [0] * x.shape[1])]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(sums)), pa.int32()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)),
                 pa.array([n] * len(sums), pa.int64()), pa.array([largest] * len(sums), pa.int64())],
                ["dim", "total", "n", "largest"])

    parts = fit.select("x").mapInArrow(run, "dim int, total decimal(38,0), n long, largest long")
    rows = parts.groupBy("dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n"),
                                    F.max("largest").alias("largest")).orderBy("dim").collect()
    return Moments(rows[0].n, [int(r.total) for r in rows], rows[0].largest) if rows else None


def summed_gram(fit: DataFrame, block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``sum of B' B`` over blocks ``B = block(rows of x)``, merged in a tree of tasks."""
    schema = "part int, gram binary"

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            if batch.num_rows:
                b = block(_matrix(batch))
                total = b.T @ b if total is None else total + b.T @ b
        if total is not None:
            yield _gram_row(TaskContext.get().partitionId(), total)

    parts = fit.select("x").mapInArrow(grams, schema)
    n = fit.rdd.getNumPartitions()
    while n > FAN:
        n = -(-n // FAN)
        group = F.floor(F.col("part") / FAN)
        parts = parts.repartitionByRange(n, group).sortWithinPartitions(group, "part")
        parts = parts.mapInArrow(_by_group, schema)
    rows = parts.orderBy("part").collect()
    total = sum(np.frombuffer(r.gram) for r in rows)
    d = int(round(len(total) ** 0.5))
    return total.reshape(d, d)


def _gram_row(part: int, gram: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.ascontiguousarray(gram).tobytes()], pa.binary())],
                                      ["part", "gram"])


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of sorted Gram matrices by ``part // FAN``, streaming."""
    group, total = None, None
    for batch in batches:
        for part, gram in zip(batch.column("part").to_pylist(), batch.column("gram").to_pylist()):
            gram = np.frombuffer(gram)
            if part // FAN == group:
                total = total + gram
                continue
            if total is not None:
                yield _gram_row(group, total)
            group, total = part // FAN, gram
    if total is not None:
        yield _gram_row(group, total)


def solve_upper(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``a @ inv(r)`` for an upper triangular ``r``, by forward substitution over the columns."""
    q = np.empty_like(a)
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


@dataclass
class Whitening:
    """Components (columns) of the fit list by falling variance, and what the result needs."""

    moments: Moments
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.moments.centred(x) @ self.components / np.sqrt(self.variances)


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of a table of distinct vectors ``x``; None when there is no vector or no variance."""
    m = moments(fit)
    if m is None or m.n < 2:
        return None
    d, factors, gram = len(m.sums), [], None
    for _ in range(MAX_PASSES):
        done = list(factors)

        def orthogonalised(x: np.ndarray, done=done, m=m) -> np.ndarray:
            q = m.centred(x)
            for r in done:
                q = solve_upper(q, r)
            return q

        last, gram = gram, summed_gram(fit, orthogonalised)
        norm = np.linalg.norm(gram, 2)
        if norm == 0:
            return None
        if factors and (np.abs(gram - np.eye(d)).max() < 1e-10 or np.abs(gram - last).max() < 1e-10):
            break
        try:
            if not factors:
                raise np.linalg.LinAlgError     # the first pass is always shifted
            factors.append(np.linalg.cholesky(gram).T)
        except np.linalg.LinAlgError:
            shift = 11 * (m.n * d + d * (d + 1)) * EPS / 2 * norm
            factors.append(np.linalg.cholesky(gram + shift * np.eye(d)).T)
    values, vectors = np.linalg.eigh(gram)
    r = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T
    for factor in reversed(factors):
        r = r @ factor
    _, s, vt = np.linalg.svd(r)
    variances = s * s / m.n
    kept = min(components, int((s > NO_VARIANCE * s[0]).sum()))
    v = vt[:kept].T.copy()
    # Either sign is right; the largest entry is made positive so that reruns agree.
    v *= np.sign(v[np.abs(v).argmax(axis=0), np.arange(kept)])
    found = Whitening(m, v, variances[:kept], variances[:kept] / variances.sum(), 0.0)

    def with_ones(x: np.ndarray) -> np.ndarray:
        return np.column_stack([found.whitened(x), np.ones(len(x))])

    g = summed_gram(fit, with_ones) / m.n
    covariance = g[:kept, :kept] - np.outer(g[:kept, kept], g[:kept, kept])
    found.identity_error = float(np.abs(covariance - np.eye(kept)).max())
    return found


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error, deviation_exact)`` of every whole vector."""
    rows = quantised(df, id_col, vector_col)
    fit = common.materialize(rows.select("x").distinct(), "distinct_vectors")
    w = fit_whitening(fit, components)
    schema = T.StructType([rows.schema["id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
                           T.StructField("deviation_exact", T.DecimalType(38, 0))])
    if w is None:
        return df.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(w.variances)
        bound = len(w.moments.sums) * (2 * w.moments.n * max(w.moments.largest, 1)) ** 2
        for batch in batches:
            x = _matrix(batch)
            dev = w.moments.deviations(x)
            if bound <= LONG_MAX:
                deviation = pa.array((dev * dev).sum(axis=1), pa.int64())
                exact = deviation.cast(pa.decimal128(38, 0))
            else:
                totals = (dev.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([t if t <= LONG_MAX else None for t in totals], pa.int64())
                exact = pa.array([Decimal(t) if t < 10 ** 38 else None for t in totals], pa.decimal128(38, 0))
            white, many = w.whitened(x), len(x)
            each = pa.array(np.repeat(np.arange(many), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                 pa.array(np.full(many * k, w.moments.n)), deviation.take(each), pa.array(white.ravel()),
                 pa.array(np.tile(w.explained, many)), pa.array(np.full(many * k, w.identity_error)), exact.take(each)],
                [f.name for f in schema])

    return rows.mapInArrow(run, schema)


def op11_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding in the four leading components."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
