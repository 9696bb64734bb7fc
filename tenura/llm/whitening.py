"""Whitening of embeddings: covariance in tasks, its leading eigenpairs by contour integration (``feast``), projection in tasks.

Vectors become whole numbers, ``floor(64 * c) + 1000000``. What travels is sums: one row a task for counts and sums, d * d numbers a task
for the centred second moments, added up by matrix row. The matrix of d * d numbers is on the driver and is sent to the tasks that
solve its intervals; it grows with the dimension, not with the rows.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import feast
from tenura.session import small_table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Largest dimension; its matrix takes 128 MB.
MAX_DIMENSION = 4096
# Rows of one product.
_ROWS = 4096
# Entries beyond this size would not be exact as doubles.
_EXACT = 1 << 52


def _usable(batch) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Positions of the usable rows of a batch, and their entries as whole numbers in one matrix for each dimension."""
    column = batch.column(1)
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column)
    row = pc.list_parent_indices(column).to_numpy(zero_copy_only=False)
    value = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    # A null entry has become NaN.
    good = size > 0
    good[row[~np.isfinite(value)]] = False
    value = value[good[row]]
    at, size = np.flatnonzero(good), size[good]
    if np.abs(value).max(initial=0.0) * SCALE >= _EXACT:
        raise ValueError(f"an embedding holds an entry beyond {_EXACT // SCALE}")
    x = np.floor(SCALE * value).astype(np.int64) + SHIFT
    if not len(size):
        return at, []
    if (size != size[0]).any():
        raise ValueError(f"embeddings have {size.min()} and {size.max()} entries; all must have as many")
    return at, [(int(size[0]), x.reshape(len(size), size[0]))]


def _sums(batches):
    held: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for d, x in _usable(batch)[1]:
            n, s = held.get(d, (0, np.zeros(d, np.int64)))
            held[d] = n + len(x), s + x.sum(axis=0)
    for d, (n, s) in held.items():
        yield pa.RecordBatch.from_pydict({"d": [d] * d, "n": [n] * d, "j": list(range(d)), "s": s.tolist()}, pa.schema([("d", pa.int32()), ("n", pa.int64()), ("j", pa.int32()), ("s", pa.int64())]))


def _centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """x - s / n, the whole part taken off exactly first."""
    whole, rest = np.divmod(s, n)
    return (x - whole).astype(float) - rest / n


def _products(d: int, make):
    """Task step: what ``make`` gives of a batch's matrix, times its own transpose, summed, one row for each row of the product."""

    def step(batches):
        total, plain = np.zeros((d, d)), np.zeros(d)
        for batch in batches:
            for _, x in _usable(batch)[1]:
                for at in range(0, len(x), _ROWS):
                    y = make(x[at : at + _ROWS])
                    total += y.T @ y
                    plain += y.sum(axis=0)
        flat = np.hstack([total, plain[:, None]])
        j = np.tile(np.arange(d + 1, dtype=np.int32), d)
        i = np.repeat(np.arange(d, dtype=np.int32), d + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(flat.ravel())], ["i", "j", "v"])

    return step


def _second_moments(read: DataFrame, n: int, d: int, make) -> np.ndarray:
    """The covariance, divisor ``n``, of the rows that ``make`` gives. Their mean is zero but for rounding, and is taken off."""
    found = read.mapInArrow(_products(d, make), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    total = np.zeros((d, d + 1))
    rows = found.toArrow()
    total[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["v"].to_numpy()
    mean = total[:, d] / n
    v = total[:, :d] / n - np.outer(mean, mean)
    return (v + v.T) / 2


class Fit:
    """Count, sums, covariance and the leading eigenpairs of the vectors that a table holds."""

    def __init__(self, n: int, sums: np.ndarray, covariance: np.ndarray, values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums, self.covariance, self.values, self.vectors = n, sums, covariance, values, vectors

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (_centred(x, self.n, self.sums) @ self.vectors) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list | np.ndarray:
        """Sum over dimensions of (n x - s) ** 2, exact."""
        span = float(np.abs(x - self.sums // self.n).max(initial=0)) + 1
        if span * span * self.n * self.n * x.shape[1] < 2**62:
            return ((self.n * (x - self.sums // self.n) - self.sums % self.n) ** 2).sum(axis=1)
        far = x.astype(object) * self.n - self.sums.astype(object)
        return (far * far).sum(axis=1)


def leading(spark: SparkSession, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenpairs of a covariance, an interval of the spectrum a task. Those that cannot be told from zero are none.

    The pairs found are as many as the inertia counts say for each interval.
    """
    parts = feast.intervals(v, wanted)
    if not parts:
        return np.empty(0), np.empty((len(v), 0))
    shared = spark.sparkContext.broadcast(v)

    def step(batches):
        for batch in batches:
            for low, high, count in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "count"))):
                values, vectors = feast.eigenpairs(shared.value, low, high, count)
                yield pa.RecordBatch.from_pydict({"value": values.tolist(), "vector": vectors.T.tolist()}, pa.schema([("value", pa.float64()), ("vector", pa.list_(pa.float64()))]))

    asked = small_table(spark, parts, "low double, high double, count int").repartition(len(parts))
    found = asked.mapInArrow(step, "value double, vector array<double>").toArrow()
    order = np.argsort(found["value"].to_numpy())[::-1]
    vectors = np.array(found["vector"].to_pylist())[order].T
    values, vectors = feast.united(v, vectors, min(wanted, vectors.shape[1]))
    # None is missing: as many eigenvalues as were found lie above the least of them.
    if feast.Inertia(v).above(values[-1] - feast.least_size(v)) < len(values):
        raise ArithmeticError("the pairs found are not the leading ones")
    return values, vectors


def fit(embeddings: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Fit | None:
    """The whitening of a table; None if no row is usable (``whiten`` says which are)."""
    read = embeddings.select(F.lit(0).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    total = read.mapInArrow(_sums, "d int, n bigint, j int, s bigint").groupBy("d", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toArrow().sort_by("j")
    dimensions = set(total["d"].to_pylist())
    if not dimensions:
        return None
    if len(dimensions) > 1:
        raise ValueError(f"embeddings have {sorted(dimensions)} entries; all must have as many")
    (d,) = dimensions
    if d > MAX_DIMENSION:
        raise ValueError(f"embeddings of {d} entries are beyond the {MAX_DIMENSION} that one matrix is for")
    n, sums = int(total["n"][0].as_py()), total["s"].to_numpy().astype(np.int64)
    v = _second_moments(read, n, d, lambda x: _centred(x, n, sums))
    values, vectors = leading(embeddings.sparkSession, v, components)
    return Fit(n, sums, v, values, vectors)


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(id_col, n, deviation, whitened, explained, identity_error)``, a row for each usable row; ``whitened`` and ``explained`` are arrays
    over the components, ``deviation`` is decimal(38,0).

    Rows whose vector is null or empty, or holds null or non-finite entries, are dropped. Vectors of different lengths, and entries beyond
    2 ** 46, are an error. Components without variance (their eigenvalue cannot be told from zero) are left out: equal
    rows only have none. Rows that repeat count again. No usable rows: no rows.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    model = fit(embeddings, vector_col, components)
    if model is None:
        return spark.createDataFrame([], schema)
    read = embeddings.select(F.col(id_col), F.col(vector_col).cast("array<double>").alias(f"{id_col}_"))
    k = len(model.values)
    shared = spark.sparkContext.broadcast(model)
    error = 0.0
    if k:
        error = float(np.abs(_second_moments(read, model.n, k, lambda x: shared.value.whiten(x)) - np.eye(k)).max())
    explained = (model.values / np.trace(model.covariance)).tolist() if k else []

    def step(batches):
        own = shared.value
        for batch in batches:
            at, parts = _usable(batch)
            for _, x in parts:
                m = len(x)
                far = own.deviations(x)
                exact = pa.array(far).cast(pa.decimal128(38, 0)) if far.dtype != object else pa.array([Decimal(int(f)) for f in far], pa.decimal128(38, 0))
                cuts = pa.array(np.arange(m + 1, dtype=np.int32) * k)
                lists = [pa.ListArray.from_arrays(cuts, pa.array(c)) for c in (own.whiten(x).ravel(), np.tile(np.array(explained, float), m))]
                columns = [batch.column(0).take(pa.array(at)), pa.repeat(pa.scalar(own.n, pa.int64()), m), exact, *lists, pa.repeat(pa.scalar(error, pa.float64()), m)]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "n", "deviation", "whitened", "explained", "identity_error"])

    return read.mapInArrow(step, schema)


def by_component(white: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """One row for each row and component of ``whiten``, numbered from 1; ``deviation`` must fit a bigint here."""
    every = white.select(id_col, "n", F.col("deviation").cast("bigint").alias("deviation"), "explained", "identity_error", F.posexplode("whitened").alias("at", "entry"))
    return every.select(
        id_col, (F.col("at") + 1).alias("component"), "n", "deviation", F.col("entry").alias("whitened"), F.element_at("explained", F.col("at") + 1).alias("explained"), "identity_error"
    )
