"""Shared pieces of the training-data operators: scans, checkpoints, Arrow maps and vectorised text tokens."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A set of keys up to this many rows is broadcast to filter a large table; beyond it, the join shuffles.
MAX_BROADCAST_KEYS = 2_000_000
BATCH_ROWS = 1_000  #: of an Arrow batch
BATCH_BYTES = 4 << 20  #: of an Arrow batch, about: rows of 100 KB fill it before BATCH_ROWS do
CUT_ROWS = 100_000  #: in a file of a checkpoint of a small table


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Has Spark hand rows to Python by BATCH_ROWS and BATCH_BYTES, where the session has its own defaults: 10,000 long texts fill memory.

    A batch is held twice, by the executor outside its heap and by the Python worker.
    """
    for name, default, value in (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", "67108864b", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, str(value))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one where it is unset (tests)."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="infield-checkpoint-"))
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return (configured or sc.getCheckpointDir()).rstrip("/")


def cut(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint in the shared folder.

    It has two files for each core of the cluster, or fewer for about ``rows`` rows: CUT_ROWS in each.
    """
    spark = df.sparkSession
    shared_dir(spark)
    files = 2 * spark.sparkContext.defaultParallelism
    return df.coalesce(files if rows is None else max(1, min(files, -(-rows // CUT_ROWS)))).checkpoint(eager=True)


class Scratch:
    """Keeps what is read more than once while a result is made, and lets go of it after: lost parts are computed again.

    ``with Scratch() as s: ... s.keep(df) ... return cut(result)``
    """

    def __init__(self) -> None:
        self.held: list[DataFrame] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        for df in self.held:
            df.unpersist()

    def keep(self, df: DataFrame) -> DataFrame:
        self.held.append(df.persist())
        return self.held[-1]


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: for rows read more than once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/infield-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def semi_join(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is in ``keys``: broadcast up to MAX_BROADCAST_KEYS keys, else a shuffled join."""
    keys = keys.select(on).where(F.col(on).isNotNull()).distinct()
    few = keys.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
    return df.join(F.broadcast(keys) if few else keys, on, "left_semi")


def pieces(batches: Iterator[pa.RecordBatch], size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``size`` bytes, so that what a task makes of them stays small."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def give_back() -> None:
    """Returns memory that is free to the system: of Arrow's pool, and of the C library where it can (glibc)."""
    pa.default_memory_pool().release_unused()
    if hasattr(ctypes.CDLL(None), "malloc_trim"):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow map that gives its memory back at a task's end: Spark keeps Python workers from stage to stage."""

    def tidied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def transform_batches(df: DataFrame, inputs: list[str], outputs: T.StructType, make: Callable) -> DataFrame:
    """``df`` with the columns that a function makes from Arrow columns ``inputs``, a run of rows at a time.

    ``make()`` is called once a task and returns the function; it gets the input arrays and returns one array for
    each output field, or a pair of those and of flags: rows whose flag is false are dropped. A column of ``df``
    with an output's name is replaced. No shuffle; rows keep their partition.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    short_batches(df.sparkSession)
    rest = df.drop(*[f.name for f in outputs if f.name not in inputs])
    arrow_outputs = to_arrow_schema(outputs)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in pieces(batches):
            made = fn(*[batch.column(i) for i in inputs])
            keep = None
            if isinstance(made, tuple) and len(made) == 2 and not isinstance(made[0], pa.Array):
                made, keep = made
            made = [m if isinstance(m, pa.Array) else pa.array(m, arrow_outputs.field(i).type) for i, m in enumerate(made)]
            out = pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *arrow_outputs.names])
            yield out if keep is None else out.filter(pa.array(keep))

    schema = T.StructType([*rest.schema.fields, *outputs.fields])
    return rest.mapInArrow(run, schema)


def each_group(df: DataFrame, key: str, fn: Callable, schema: T.StructType, partitions: int | None = None) -> DataFrame:
    """Apply ``fn(table)`` to the rows of each ``key``, streamed from sorted partitions.

    Only for groups whose size the caller has bounded: one group's rows are in memory at a time.
    ``fn`` returns a dict of columns, or None for no rows. Cheaper than applyInPandas for many small groups.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    short_batches(df.sparkSession)
    arrow_schema = to_arrow_schema(schema)
    dealt = df.repartition(partitions, key) if partitions else df.repartition(F.col(key))

    def emit(parts: list[dict]) -> pa.RecordBatch:
        merged = [np.concatenate([p[n] for p in parts]) for n in arrow_schema.names]
        return pa.RecordBatch.from_arrays([pa.array(m, t) for m, t in zip(merged, arrow_schema.types, strict=True)], schema=arrow_schema)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        last = None

        def close() -> dict | None:
            return fn(pa.Table.from_batches(waiting).combine_chunks()) if waiting else None

        for batch in batches:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            parts = []
            for a, b in zip(bounds, bounds[1:], strict=False):
                if waiting and keys[a] != last:
                    if (out := close()) is not None:
                        parts.append(out)
                    waiting = []
                waiting.append(batch.slice(a, b - a))
                last = keys[a]
            if parts:
                yield emit(parts)
        if (out := close()) is not None:
            yield emit([out])

    return dealt.sortWithinPartitions(key).mapInArrow(run, schema)


def collected_arrays(df: DataFrame) -> dict[str, np.ndarray]:
    """A small, size-bounded DataFrame as numpy arrays on the driver."""
    table = df.toArrow()
    return {n: table.column(n).to_numpy() for n in table.column_names}


# ---------------------------------------------------------------------------------------------------------
# Text as arrays

def text_list(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null is empty."""
    return [t if t is not None else "" for t in column.to_pylist()]


def slices(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose lengths sum to about ``limit`` at most; a longer row stands alone."""
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(lengths) > start:
        yield start, len(lengths)


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


_MUL = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of the words of many texts at once.

    A word is a maximal run of ASCII letters and digits and of non-ASCII characters; ASCII letters and the
    capitals of Latin-1 count as lower case. Hashing is a prefix sum of a polynomial over the UTF-8 bytes.
    """

    def __init__(self, chunk: int = 1 << 20):
        self.chunk = chunk
        base = np.uint64(0xD6E8FEB86659FD93)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.powers = np.cumprod(np.full(chunk, base, np.uint64))
        self.inverses = np.cumprod(np.full(chunk, inverse, np.uint64))
        code = np.arange(256, dtype=np.uint8)
        self.lower = np.where((code >= 65) & (code <= 90), code + 32, code).astype(np.uint8)
        self.word = ((code >= 48) & (code <= 57)) | ((self.lower >= 97) & (self.lower <= 122)) | (code >= 128)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            self.__init__(1 << int(n - 1).bit_length())

    def __call__(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Yields (first row, word hashes, offsets of each row's words) for runs of rows; null is empty."""
        for a, _, _, hashes, at, _ in self.words(column):
            yield a, hashes, at

    def words(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Yields (first row, bytes, offsets of the rows in them, word hashes, offsets of each row's words, first bytes of the words)."""
        if column.null_count:
            column = column.fill_null("")
        column = column.cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
        limit = 1 << 20
        for a, b in slices(np.diff(offsets), limit):
            rows, edges = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            yield a, rows, edges, *self.hash_rows(rows, edges)

    def hash_rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(data)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
        self._grow(n)
        low = self.lower[data]
        latin = np.flatnonzero(data[:-1] == 0xC3) + 1
        capital = latin[(data[latin] >= 0x80) & (data[latin] <= 0x9E) & (data[latin] != 0x97)]
        low[capital] += 32
        inside = self.word[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[:-1][offsets[:-1] < n]
        begins[edges] = inside[edges]
        starts = np.flatnonzero(begins)
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        tails = offsets[1:][offsets[1:] > 0] - 1
        closes[tails] = inside[tails]
        ends = np.flatnonzero(closes) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverses[starts])
        return hashes, np.searchsorted(starts, offsets), starts


def shingles(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words and each row's offsets into them.

    A row with words, but fewer than ``width``, has one shingle of all its words.
    """
    counts = np.diff(offsets)
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    row_end = np.repeat(offsets[1:], counts)
    at = np.arange(n)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        factor = np.uint64(pow(_MUL, k + 1, 1 << 64))
        total += np.where(at + k < row_end, padded[k : k + n], np.uint64(0)) * factor
    first = np.repeat(offsets[:-1], counts)
    valid = (at + width <= row_end) | (at == first) & (row_end - first < width)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    return mix(total[valid]), np.concatenate([[0], np.cumsum(made)])
