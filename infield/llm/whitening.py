"""Embedding whitening by a two-pass covariance.

The first pass sums the distinct integer vectors exactly, which gives their mean without rounding. The second centres them
and adds up outer products, one matrix product a chunk, and treeAggregate merges the tasks' matrices. LAPACK's symmetric
eigensolver gives the components on the driver, where one matrix of dimensions by dimensions is all that arrives; the
projection is broadcast.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from infield.llm.common import stored, tidy
from infield.llm.exact_vectors import CHUNK, LONGEST, Totals, by_literal, exact_totals, finite_vectors, pack, packed, unpacked


class Fit:
    """Count, exact sums and what follows from them for one length of vectors."""

    def __init__(self, n: int, sums: list[int], shift: int):
        self.n, self.sums, self.shift = n, sums, shift  # shift: centred components count in units of 2**shift
        self.whole = np.array([s // n for s in sums], object)
        self.rest = np.array([(s % n) / n for s in sums])
        self.small = all(abs(int(v)) < 2**40 for v in self.whole)

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """x - S/n as doubles, in units of 2**shift."""
        if rows.dtype != object and self.small:
            return ((rows - self.whole.astype(np.int64)) - self.rest) * 2.0**-self.shift
        exact = rows.astype(object) * self.n - np.array(self.sums, object)
        return (exact / (self.n << self.shift)).astype(np.float64)

    def deviation(self, rows: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n*x - S)**2, exact; None where no long holds it."""
        largest = max((abs(s) for s in self.sums), default=0)
        if rows.dtype != object and largest + self.n * int(np.abs(rows).max(initial=0)) < 2**62:
            far = rows * self.n - np.array(self.sums, np.int64)
            about = (far.astype(np.float64) ** 2).sum(axis=1)
            with np.errstate(over="ignore"):
                exact = (far * far).sum(axis=1)  # modulo 2**64, which is the sum itself where that is below 2**63
            out: list[int | None] = exact.tolist()
            for i in np.flatnonzero(about > 2.0**63 * 0.999).tolist():
                value = sum(v * v for v in far[i].tolist())
                out[i] = value if value <= LONGEST else None
            return out
        sums = sum(v * v for v in (rows.astype(object) * self.n - np.array(self.sums, object)).T)
        return [v if v <= LONGEST else None for v in sums.tolist()]


def _merged(rows: DataFrame, dim: int, size: int, make: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all chunks of the ``size`` doubles that ``make`` gives, merged by treeAggregate."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for _, matrix in unpacked(batch.column(0), dim):
                total += make(matrix)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    parts = rows.select("packed").mapInArrow(run, "total binary").rdd.map(lambda r: np.frombuffer(r[0]))
    return parts.treeAggregate(np.zeros(size), operator.add, operator.add)


def _of_length(vectors: DataFrame, dim: int, components: int, scale: int, key: str, embedding: str) -> DataFrame | None:
    fit_list = stored(pack(vectors, key, embedding, scale, dim).select("packed").distinct())

    def add(totals: Totals, rows: np.ndarray) -> None:
        totals.add(0, np.append(rows.sum(axis=0), len(rows)))
        totals.add(1, (rows * rows).sum(axis=0))

    sums = exact_totals(fit_list, dim, add)
    if not sums:
        return None
    n = sums[0][dim]
    # units of a power of two keep squares of very large components within doubles; whitening doesn't depend on them
    fit = Fit(n, [sums[0][d] for d in range(dim)], max(0, max(sums[1].values()).bit_length() // 2 - 300))

    def outer(rows: np.ndarray) -> np.ndarray:
        c = fit.centred(rows)
        return (c.T @ c).ravel()

    covariance = _merged(fit_list, dim, dim * dim, outer).reshape(dim, dim) / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    most = min(components, dim)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(np.trace(covariance))
    usable = int((values[:most] > max(values[0], 0.0) * dim * np.finfo(float).eps).sum())
    shares = [float(v / trace) if trace > 0 else None for v in values[:most]]
    projection = vectors.sparkSession.sparkContext.broadcast(axes[:, :usable] / np.sqrt(values[:usable]))

    def whitened_outer(rows: np.ndarray) -> np.ndarray:
        w = fit.centred(rows) @ projection.value
        return np.append((w.T @ w).ravel(), w.sum(axis=0))

    error = None
    if usable:
        moments = _merged(fit_list, dim, usable * usable + usable, whitened_outer) / n
        mean = moments[usable * usable :]
        error = float(np.abs(moments[: usable * usable].reshape(usable, usable) - np.outer(mean, mean) - np.eye(usable)).max())
    chosen = vectors.select(F.col(key), F.col(embedding).alias("_v"))
    made = T.StructType([chosen.schema[0], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    @tidy
    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                at, rows = finite_vectors(part.column(1), dim)
                for own, whole in unpacked(pa.array(packed(rows, scale), pa.binary()), dim):
                    w = np.full((len(own), most), np.nan)
                    w[:, :usable] = fit.centred(whole) @ projection.value
                    flat = pa.array(w.ravel(), pa.float64(), from_pandas=True)  # no number is null
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(own) * most + 1, most, dtype=np.int32)), flat)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at[own])), pa.array(fit.deviation(whole), pa.int64()), lists], names=made.names)

    spread = chosen.mapInArrow(project, made).select(key, "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return spread.select(
        key,
        (F.col("_at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        by_literal(shares, "double", F.col("_at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def whiten(vectors: DataFrame, components: int = 16, scale: int = 64, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """key, component, n, deviation, whitened, explained and identity_error of every finite vector, for its first components.

    Rows whose vector is null or empty or holds null, NaN or infinite components are left out. A component c counts as the
    integer floor(scale * c); whitening doesn't depend on a constant added to all of them. Mean and covariance are those of
    the distinct integer vectors. Vectors of another length are whitened among themselves. Components without variance (to
    the rank of a matrix in doubles) have null in ``whitened`` and take no part in ``identity_error``; with one distinct
    vector these are all. ``deviation`` is null where no long holds it. Repeated rows each have their rows. An empty table
    has an empty result. Other columns of ``vectors`` are not looked at.
    """
    schema = T.StructType([T.StructField(key, vectors.schema[key].dataType), *T._parse_datatype_string("component int, n long, deviation long, whitened double, explained double, identity_error double").fields])
    lengths = sorted(r[0] for r in vectors.groupBy(F.size(embedding)).count().collect() if r[0] is not None and r[0] > 0)
    found = [f for dim in lengths if (f := _of_length(vectors, dim, components, scale, key, embedding)) is not None]
    if not found:
        return vectors.sparkSession.createDataFrame([], schema)
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other)
    return out
