"""Centroid clustering in integers by partial-distance search.

Components become integers once, and are stored packed. A round assigns every vector to its nearest centroid: squared
differences are added up over the dimensions of the largest variance first, a step of them at a time; a centroid is given
up for a vector as soon as the partial sum is strictly above the vector's best distance, and only survivors finish all
dimensions. A task adds its vectors to exact sums of each centroid, so that what is shuffled is one small table a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from infield.llm.common import stored, tidy
from infield.llm.exact_vectors import LONGEST, Totals, exact_totals, fits, narrow_limit, pack, unpacked

STEP = 8  #: dimensions between two looks at which vectors go on


def nearest(rows: np.ndarray, centroids: np.ndarray, order: np.ndarray, work: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and squared distance of each row; ``work`` collects dimensions used."""
    if centroids.dtype == object:
        rows = rows.astype(object)
    x = np.ascontiguousarray(rows[:, order].T)
    centres = centroids[:, order]
    n, dim = rows.shape
    best, cluster = np.zeros(n, x.dtype), np.zeros(n, np.int32)
    for c, centre in enumerate(centres):
        alive, part = np.arange(n), np.zeros(n, x.dtype)
        for a in range(0, dim, STEP):
            gap = (x[a : a + STEP] if len(alive) == n else x[a : a + STEP, alive]) - centre[a : a + STEP, None]
            part = part + (gap * gap).sum(axis=0)
            if work is not None:
                work.append(gap.size)
            if c:
                on = (part <= best[alive]).astype(bool)
                if not on.all():
                    alive, part = alive[on], part[on]
                    if not len(alive):
                        break
        closer = (part < best[alive]).astype(bool) if c else np.ones(n, bool)
        best[alive[closer]], cluster[alive[closer]] = part[closer], c
    return cluster, best


def _matrix(centroids: list[list[int]], dim: int) -> np.ndarray:
    narrow = all(abs(v) <= narrow_limit(dim) for row in centroids for v in row)
    out = np.empty((len(centroids), dim), np.int64 if narrow else object)
    out[:] = centroids
    return out


def _moved(kept: DataFrame, centroids: list[list[int]], order: np.ndarray, dim: int) -> list[list[int]]:
    """Each centroid's vectors' floor of sum by count; a centroid without vectors stays."""
    centres = _matrix(centroids, dim)

    def add(totals: Totals, rows: np.ndarray) -> None:
        cluster, _ = nearest(rows, centres, order)
        for c in np.unique(cluster).tolist():
            own = rows[cluster == c]
            totals.add(c, np.append(own.sum(axis=0), len(own)))

    sums = exact_totals(kept, dim, add)
    return [[sums[c][d] // sums[c][dim] for d in range(dim)] if c in sums else centroids[c] for c in range(len(centroids))]


def _variance_order(kept: DataFrame, dim: int) -> np.ndarray:
    """The dimensions by falling variance, ties by number; it decides how much work is done, not what is found."""

    def add(totals: Totals, rows: np.ndarray) -> None:
        totals.add(0, rows.sum(axis=0))
        totals.add(1, (rows * rows).sum(axis=0))
        totals.add(2, np.array([len(rows)]))

    sums = exact_totals(kept, dim, add)
    n = sums[2][0]
    return np.array(sorted(range(dim), key=lambda d: sums[0][d] ** 2 - n * sums[1][d]), dtype=np.int64)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector after ``rounds`` rounds.

    Vectors with exactly ``dim`` components, none null, NaN or infinite, take part; others are left out. Components count
    as floor(scale * x). The first centroids are the ``k`` vectors with the least SHA-256 of "seed:key", in that order (ties
    by components; null keys last); fewer vectors make fewer centroids. An empty centroid stays where it is. Repeated rows
    count as often as they are there. Distances are exact at any size; a distance or sum that no long holds is null.
    An empty table has an empty result. Other columns of ``vectors`` are not looked at.
    """
    spark = vectors.sparkSession
    kept = stored(pack(vectors, key, embedding, scale, dim))
    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    drawn = kept.orderBy(first.asc_nulls_last(), "packed").limit(k).select("packed").toArrow().column(0).to_pylist()
    schema = T.StructType([kept.schema[0], *T._parse_datatype_string("cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string").fields])
    if not drawn:
        return spark.createDataFrame([], schema)
    centroids = [next(unpacked(pa.array([p], pa.binary()), dim))[1][0].tolist() for p in drawn]
    order = _variance_order(kept, dim)
    for _ in range(rounds):
        moved = _moved(kept, centroids, order, dim)
        if moved == centroids:  # every further round would give the same
            break
        centroids = moved
    centres = _matrix(centroids, dim)

    def add(totals: Totals, rows: np.ndarray) -> None:
        own, distance = nearest(rows, centres, order)
        for c in np.unique(own).tolist():
            totals.add(c, np.array([distance[own == c].sum()]))

    sums = exact_totals(kept, dim, add)
    spread = [fits(sums[c][0]) for c in range(len(centroids))]
    inertia = fits(sum(sums[c][0] for c in range(len(centroids))))
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids]

    @tidy
    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows in unpacked(batch.column(1), dim):
                own, distance = nearest(rows, centres, order)
                far = distance if distance.dtype != object else [v if v <= LONGEST else None for v in distance.tolist()]
                n = pa.array(own)
                columns = [batch.column(0).take(pa.array(at)), n, pa.array(far, pa.int64()), pa.array(spread, pa.int64()).take(n), pa.array([inertia] * len(at), pa.int64()), pa.array(digests).take(n)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(assign, schema)
