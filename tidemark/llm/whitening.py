"""Embedding whitening: vectors on the leading components of their covariance, scaled to unit variance.

Entries become whole numbers, so sums are exact in any order. Tasks centre their vectors with the exact mean, multiply
them out and hand on one triangle each, which Spark adds up by cell. The matrix has the size of the vectors,
not of the table: its leading eigenpairs are found on the driver (:mod:`tidemark.llm.eigen`), and the
components go out to the tasks for the projection.

Defined cases: rows whose vector is null or has null, NaN or infinite entries are left out. So are rows of another
length than most (of lengths that are equally common, the greater counts) and empty vectors. Entries beyond 2**52 as
whole numbers are taken as that. Ids may be null or repeat: every row gets its own result. Components of (nearly) no
variance cannot be scaled and are left out, so a table of equal vectors, of one vector or of none gives no
rows. ``deviation`` is null where it exceeds a long. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped
from tidemark.llm.eigen import EPS, leading_pairs
from tidemark.session import materialized

COMPONENTS = 8
SCALE = 1024.0
OFFSET = 100_000
GREATEST = 1 << 52
PIECE = 1 << 20  # entries that are worked on at once
SAFE = float(1 << 62)


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id`` and ``vec`` (doubles) of the rows that have a whole vector."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    vec = F.col(vec_col).cast("array<double>")
    rows = rows.select(F.col(id_col).alias("id"), vec.alias("vec"))
    return rows.filter(F.col("vec").isNotNull() & (F.size("vec") > 0) & F.forall("vec", finite))


def whole(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of a batch as whole numbers, a piece at a time, with the place of the piece."""
    values = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    step = max(1, PIECE // size)
    for at in range(0, len(values), step):
        x = np.floor(SCALE * np.clip(values[at : at + step], -GREATEST, GREATEST))
        yield at, np.clip(x, -GREATEST, GREATEST).astype(np.int64) + OFFSET


def exact(x: np.ndarray, factor: float) -> np.ndarray:
    """``x`` as it is if its entries times ``factor`` fit 64 bits, else with unbounded integers."""
    return x if float(np.abs(x).max(initial=0)) * factor < SAFE else x.astype(object)


@dataclass(frozen=True)
class Whitening:
    """A fit: number of vectors, sums, leading eigenvalues, components as columns, and the total variance."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace for v in self.values]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        sums = np.array(self.sums, object)
        if float(max(map(abs, self.sums))) < SAFE:
            x, sums = exact(x, 2.0 * self.n), sums.astype(np.int64)
        else:
            x = x.astype(object)
        return x * self.n - sums


def _sums(vectors: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, object)
        for batch in batches:
            for _, x in whole(batch, size):
                n, sums = n + len(x), sums + exact(x, len(x)).sum(axis=0).astype(object)
        rows = [*range(size), -1], [*(int(s) for s in sums), n]
        yield pa.record_batch([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.decimal128(38, 0))], ["at", "part"])

    parts = mapped(vectors.select("vec"), run, "at int, part decimal(38,0)")
    total = {r["at"]: int(r["total"]) for r in parts.groupBy("at").agg(F.sum("part").alias("total")).collect()}
    return total.get(-1, 0), [total.get(i, 0) for i in range(size)]


def _covariance(vectors: DataFrame, size: int, n: int, sums: list[int]) -> np.ndarray:
    """Divisor n, centred before the entries are multiplied. One triangle a task, added up by cell."""
    fit = Whitening(n, sums, np.zeros(0), np.zeros((size, 0)), 0.0)
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((size, size))
        for batch in batches:
            for _, x in whole(batch, size):
                y = fit.deviations(x).astype(float) / n
                products += y.T @ y
        cells = [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(products[upper])]
        yield pa.record_batch(cells, ["i", "j", "part"])

    parts = mapped(vectors.select("vec"), run, "i int, j int, part double")
    matrix = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("part").alias("total")).collect():
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = r["total"] / n
    return matrix


def fit(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors; None if there are none."""
    vectors = usable(rows, id_col, vec_col)
    lengths = vectors.groupBy(F.size("vec").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return None
    size = most["size"]
    vectors = vectors.filter(F.size("vec") == size)
    n, sums = _sums(vectors, size)
    matrix = _covariance(vectors, size, n, sums)
    values, parts = leading_pairs(matrix, components)
    trace = float(np.trace(matrix))
    scalable = values > size * EPS * trace
    return Whitening(n, sums, values[scalable], parts[:, scalable], trace)


def whitened(rows: DataFrame, fitted: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id``, ``deviation`` and the ``whitened`` coordinates of every usable vector of the fit's length."""
    size = len(fitted.sums)
    vectors = usable(rows, id_col, vec_col).filter(F.size("vec") == size)
    scaled = fitted.components / np.sqrt(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in whole(batch, size):
                gaps = fitted.deviations(x)
                floats = gaps.astype(float)
                squares = exact(gaps, float(np.abs(floats).max(initial=0.0)) * size)
                total = (squares * squares).sum(axis=1)
                long = [int(t) if int(t) < 1 << 63 else None for t in total] if total.dtype == object else total
                out = (floats / fitted.n) @ scaled
                offsets = np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))
                ids = batch.column("id").slice(at, len(out))
                yield pa.record_batch([ids, pa.array(long, pa.int64()), lists], ["id", "deviation", "whitened"])

    schema = T.StructType(
        [vectors.schema["id"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    )
    return mapped(vectors, run, schema)


def identity_error(projected: DataFrame, k: int) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity, measured over all of them."""
    w = [F.col("whitened")[i] for i in range(k)]
    gaps = [F.abs(F.covar_pop(w[i], w[j]) - F.lit(float(i == j))) for i in range(k) for j in range(i + 1)]
    return projected.agg(F.array_max(F.array(*gaps))).first()[0]


def op12_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """All embeddings on up to eight components of their own covariance, one row a component."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return components_of(rows)


def components_of(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component, with what the fit has of it."""
    fitted = fit(rows, id_col, vec_col, components)
    k = len(fitted.values) if fitted else 0
    if not k:
        fields = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        schema = T.StructType([T.StructField(id_col, rows.schema[id_col].dataType), *T.StructType.fromDDL(fields)])
        return rows.sparkSession.createDataFrame([], schema)
    projected = materialized(whitened(rows, fitted, id_col, vec_col), "whitened")
    off = identity_error(projected, k)
    explained = F.array(*[F.lit(e) for e in fitted.explained])
    long = projected.select(F.col("id").alias(id_col), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        id_col,
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(float(off)).alias("identity_error"),
    )
