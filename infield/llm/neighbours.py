"""Approximate nearest neighbours by inner product with collision-counting hashing.

Vectors of about the same norm are scaled by the largest of these norms and lifted to the unit sphere by one more
component, which makes the largest inner product the least angle. A block of such vectors is indexed once: each vector is
hashed by the signs of PROJECTIONS single projections, kept as bits. Two vectors collide in a projection where their signs
are the same, and the share of collisions tells their angle. For a query all collisions with a block are counted at once,
by words of 64 bits. Vectors are verified by falling numbers of collisions: their exact inner product, in double
precision. The search of a block ends when a vector at the angle of the k-th best verified would have had as many
collisions as are asked for by now, by the binomial distribution of collisions, with the stated safety.

Blocks are of bounded size, and queries stream past them. A block is copied only where there are more cores than blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROJECTIONS = 256
SAFETY = 1.1  #: standard deviations of the number of collisions by which a vector at the final angle exceeds what is asked for
FIRST = 4  #: times as many vectors as are wanted are verified before the first look at the angle
BLOCK = 32_768  #: vectors of a block, about
TOGETHER = 32  #: queries that are searched for at once

FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("verified", T.LongType())])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles), dim and class of the rows with an id whose vector is not null, empty or zero and has no null or non-finite component.

    The class is the exponent of two of the vector's norm, computed without overflow.
    """
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column("embedding")
            size = rows.value_lengths().to_numpy()
            starts = np.concatenate([[0], np.cumsum(size[:-1])])
            values = rows.flatten().to_numpy(zero_copy_only=False)  # null components become NaN
            finite = np.logical_and.reduceat(np.isfinite(values), starts)
            values = np.abs(np.where(np.isfinite(values), values, 0.0))
            largest = np.maximum.reduceat(values, starts)
            own = np.repeat(np.where(largest > 0, largest, 1.0), size)
            squares = np.add.reduceat((values / own) ** 2, starts)
            good = finite & (largest > 0)
            kind = np.zeros(len(size), np.int32)
            kind[good] = np.floor(np.log2(largest[good]) + np.log2(squares[good]) / 2)
            made = pa.RecordBatch.from_arrays([batch.column("vec_id"), rows, pa.array(size, pa.int32()), pa.array(kind)], names=["vec_id", "embedding", "dim", "class"])
            yield made.filter(pa.array(good))

    return given.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).mapInArrow(run, "vec_id long, embedding array<double>, dim int, class int")


def lengths(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest component and norm in units of it, of each row: neither overflows."""
    largest = np.abs(rows).max(axis=1)
    return largest, np.sqrt(((rows / largest[:, None]) ** 2).sum(axis=1))


class Block:
    """The index of some vectors of one length."""

    def __init__(self, data: np.ndarray, ids: np.ndarray):
        self.data, self.ids, self.repeated = data, ids, len(np.unique(ids)) < len(ids)
        n, dim = data.shape
        largest, norm = lengths(data)
        top = int(np.argmax(np.log2(largest) + np.log2(norm)))
        self.longest = float(largest[top]) * float(norm[top])
        # in units of the longest vector, in an order that neither overflows nor underflows early
        self.scaled = data / largest[top] / norm[top]
        lift = np.sqrt(np.maximum(0.0, 1.0 - (self.scaled**2).sum(axis=1)))
        self.drawn = np.random.default_rng(dim).standard_normal((dim + 1, PROJECTIONS))
        self.bits = np.ascontiguousarray(self._signs(self.scaled @ self.drawn[:dim] + lift[:, None] * self.drawn[dim]).T)

    @staticmethod
    def _signs(shadows: np.ndarray) -> np.ndarray:
        return np.packbits(shadows > 0, axis=1).view(np.uint64)

    def _verified(self, query: np.ndarray, signs: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The vectors whose number of collisions with a query may make them one of the best ``k``, with products of unit length."""
        apart = np.add.reduce(np.bitwise_count(self.bits ^ signs[:, None]), axis=0, dtype=np.uint16)  # projections without collision
        apart[self.ids == own] = PROJECTIONS + 1  # a query's own row is no candidate
        upto = np.cumsum(np.bincount(apart, minlength=PROJECTIONS + 2)[: PROJECTIONS + 1])
        limit = min(int(np.searchsorted(upto, FIRST * k)), PROJECTIONS)
        at = np.flatnonzero(apart <= limit)
        near = self.scaled[at] @ query
        enough = self._enough(near, at, k)
        while limit < enough:
            further = (limit + enough + 1) // 2
            new = np.flatnonzero((apart <= further) & (apart > limit))
            limit = further
            if len(new):
                at, near = np.concatenate([at, new]), np.concatenate([near, self.scaled[new] @ query])
                enough = self._enough(near, at, k)
        return at, near

    def _last(self, near: np.ndarray, at: np.ndarray, k: int) -> float | None:
        """The product of the ``k``-th best id; none, if there are fewer."""
        if len(near) >= k and self.repeated:
            by = np.argsort(-near, kind="stable")
            _, first = np.unique(self.ids[at[by]], return_index=True)
            near = near[by[first]]
        return float(np.partition(near, -k)[-k]) if len(near) >= k else None

    def _enough(self, near: np.ndarray, at: np.ndarray, k: int) -> int:
        """Projections without collision up to which vectors at the angle of the ``k``-th best are found; all, if there are fewer."""
        last = self._last(near, at, k)
        if last is None:
            return PROJECTIONS
        share = float(np.arccos(np.clip(last, -1.0, 1.0))) / np.pi
        return min(PROJECTIONS, int(np.ceil(PROJECTIONS * share + SAFETY * (PROJECTIONS * share * (1 - share)) ** 0.5)))

    def search(self, queries: np.ndarray, query_ids: np.ndarray, k: int) -> dict[str, np.ndarray]:
        """The best ``k`` different ids for each query."""
        dim = self.data.shape[1]
        largest, norm = lengths(queries)
        unit = queries / largest[:, None] / norm[:, None]
        signs = self._signs(unit @ self.drawn[:dim])
        out: list[tuple] = []
        for q in range(len(queries)):
            at, near = self._verified(unit[q], signs[q], query_ids[q], k)
            looked = len(at)
            last = self._last(near, at, k)
            if last is not None and 1e-250 < self.longest * float(largest[q]) * float(norm[q]) < 1e250:
                at = at[near >= last - 1e-9]  # others are beyond the rounding of a product
            with np.errstate(over="ignore", invalid="ignore"):
                score = (self.data[at] * queries[q]).sum(axis=1)
            by = np.lexsort((self.ids[at], np.where(np.isnan(score), np.inf, -score)))
            at, score = at[by], score[by]
            if self.repeated:
                _, first = np.unique(self.ids[at], return_index=True)
                first.sort()
                at, score = at[first], score[first]
            m = min(k, len(at))
            out.append((np.full(m, query_ids[q]), self.ids[at[:m]], score[:m], np.full(m, looked)))
        return {name: np.concatenate([o[i] for o in out]) for i, name in enumerate(FOUND.names)}


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """The answers of each ``pair`` of a block (its vectors come first) and queries, streamed from sorted partitions."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block, waiting = None, None, []

        def vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            ids = batch.column("vec_id").to_numpy()
            return batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1), ids

        for batch in batches:
            pair = batch.column("pair").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((pair[1:] != pair[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(pair)], strict=True):
                if a == b:
                    continue
                if pair[a] != last:
                    last, block, waiting = pair[a], None, []
                data, ids = vectors(batch.slice(a, b - a))
                if not asks[a]:
                    waiting.append((data, ids))
                    continue
                if block is None and waiting:
                    block, waiting = Block(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting])), []
                if block is not None:
                    for at in range(0, len(ids), TOGETHER):
                        found = block.search(data[at : at + TOGETHER], ids[at : at + TOGETHER], k)
                        yield pa.RecordBatch.from_arrays([pa.array(found[f.name], pa.float64() if f.name == "score" else pa.int64()) for f in FOUND], names=FOUND.names)

    return pairs.sortWithinPartitions("pair", "asks", "vec_id").mapInArrow(run, FOUND)


def found_in_blocks(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score and verified (vectors of the block that were) of the best k of each block for each query."""
    spark = vectors.sparkSession
    vectors, queries = usable(vectors), usable(queries)
    kind = F.struct("dim", "class")
    classes = vectors.groupBy(kind.alias("kind")).count().collect()  # a row for each length and power of two
    if not classes:
        return spark.createDataFrame([], FOUND)
    classes.sort(key=lambda r: (r.kind.dim, r.kind["class"]))
    first, blocks, of_dim = 0, {}, {}
    for r in classes:
        n = -(-r["count"] // BLOCK)
        blocks[r.kind.dim, r.kind["class"]] = first, n
        of_dim.setdefault(r.kind.dim, []).extend(range(first, first + n))
        first += n
    slices = max(1, -(-2 * spark.sparkContext.defaultParallelism // first))
    place = F.create_map(*[x for (d, c), (at, n) in blocks.items() for x in (F.struct(F.lit(d).alias("dim"), F.lit(c).alias("class")), F.struct(F.lit(at).alias("at"), F.lit(n).alias("n")))])[kind]
    block = place["at"] + F.pmod(F.xxhash64("vec_id", F.lit(7)), place["n"])
    met = F.create_map(*[x for d, own in of_dim.items() for x in (F.lit(d), F.array(*map(F.lit, own)))])[F.col("dim")]
    stored = vectors.select(block.alias("block"), F.lit(False).alias("asks"), "vec_id", "embedding").withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    asking = queries.select(F.explode(met).alias("block"), F.lit(True).alias("asks"), "vec_id", "embedding").withColumn("slice", F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(slices)))
    pairs = stored.unionByName(asking).withColumn("pair", (F.col("block") * slices + F.col("slice")).cast("long")).select("pair", "asks", "vec_id", "embedding")
    return _search(pairs.repartition(4 * first * slices, "pair"), k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest of ``vectors`` found for each of ``queries`` (both vec_id, embedding).

    A query's own row (same id) is no candidate. Scores are inner products of the vectors as given, in double
    precision; ties go to the smaller id, a product that is no number comes last. Repeated rows count once; of
    different vectors with the same id the best counts, as a candidate and as a query. Vectors that usable() leaves out
    take no part; vectors meet only those of their own length.
    """
    found = found_in_blocks(vectors, queries, k)
    best = found.groupBy("query_id", "vec_id").agg(F.max(F.when(F.isnan("score"), -float("inf")).otherwise(F.col("score"))).alias("order"), F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("order"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
