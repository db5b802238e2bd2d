"""Sums of n-gram log probabilities by text, from a join of the texts' n-grams with whole sharded count tables.

No model is gathered anywhere, and no n-gram is left out. An n-gram belongs to the shard of the last two symbols of its
context: there lie all n-grams of order three and more that its probability backs off to, so a shard makes its part of
the model from its counts alone, with the discounts and the small model of the two lowest orders, which all shards share.
Tasks turn chunks of texts into n-grams with the texts that have them, dealt by shard; a shard adds up its share of
each text's sum, and the shares come back by chunk. Texts are known by a digest and never move.

A chunk is what one task makes of its rows, so the input's rows must come in the same order if a lost task is run again,
as those of a scan do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from infield.llm.char_lm import BITS, BUCKETS, SortedModel, bucket_of, discounts, extend, grams, mask, merged, symbols
from infield.llm.common import codepoints, cut, each_group, pieces, short_batches, text_list, tidy

HELD = 2_000_000  #: symbols of texts in a chunk, about
TEXTS = 60_000  #: in a chunk at most, so that their numbers fit 16 bits
PIECE = 65_536  #: places of n-grams in a row that is sent, about: some 100 KB
BLOCK = 250_000  #: places whose shards are worked out at once
GRAMS = 1_000_000  #: n-grams of the count tables in a shard, about
MODEL, TEXT, HEAD = 0, 1, 2  #: kinds of rows: counts; n-grams of a chunk; digests and lengths of its texts


def digest(text: str = "text") -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


@dataclass
class Tables:
    """The models of ``names``: whole counts (bucket, model, gram, n), and what all shards share."""

    names: list[str]
    counts: DataFrame
    size: int  #: n-grams in counts
    order: int
    discounts: list[list[tuple[float, float, float]]]  #: by model, of orders 3 and up
    low: list[SortedModel]  #: orders 1 and 2; their symbols have 12 bits each, which bounds them


def learn(counts: DataFrame, order: int) -> Tables:
    """Count-of-count discounts and the lowest orders from ``counts``; lower orders count the different symbols before."""
    counts = cut(counts)
    level, rows = counts.select("model", "gram", "n"), []
    for k in range(order, 2, -1):
        rows.append(level.where("n <= 4").groupBy("model", F.col("n").alias("key")).agg(F.count("*").alias("found")).withColumn("k", F.lit(k)))
        level = level.groupBy("model", F.col("gram").bitwiseAND(F.lit(mask(k - 1))).alias("gram")).agg(F.count("*").alias("n"))
    rows.append(level.select("model", F.col("gram").alias("key"), F.col("n").alias("found"), F.lit(2).alias("k")))
    both = rows[0]
    for other in rows[1:]:
        both = both.unionByName(other)
    told = both.toArrow()
    model, k, key, found = (told.column(c).to_numpy(zero_copy_only=False) for c in ("model", "k", "key", "found"))
    names = sorted(set(model.tolist()))
    low, off = [], []
    for name in names:
        own = model == name
        bigrams = merged(key[own & (k == 2)], found[own & (k == 2)].astype(np.float64))
        first = merged(bigrams[0] & mask(1), np.ones(len(bigrams[0])))
        base = SortedModel([], [], [], [], -float(np.log(len(first[0]) + 1.0)))
        for g, n in (first, bigrams):
            extend(base, g, n, discounts({i: int((n == i).sum()) for i in (1, 2, 3, 4)}))
        low.append(base)
        off.append([discounts(dict(zip(key[own & (k == j)].tolist(), found[own & (k == j)].tolist(), strict=True))) for j in range(3, order + 1)])
    return Tables(names, counts, counts.count() if names else 0, order, off, low)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of integers as bytes: planes of equal significance, compressed."""
    planes = b"".join(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    head = np.array([len(arrays), *[len(a) for a in arrays], *[a.itemsize for a in arrays]], np.int64)
    return head.tobytes() + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 1 + 2 * n)[1:]
    planes = np.frombuffer(pa.decompress(data[8 * (1 + 2 * n) :], int((head[:n] * head[n:]).sum()), "zstd"), np.uint8)
    out, at = [], 0
    for length, size in zip(head[:n].tolist(), head[n:].tolist(), strict=True):
        out.append(np.ascontiguousarray(planes[at : at + length * size].reshape(size, length).T).view(f"u{size}").ravel())
        at += length * size
    return out


def _turned(gram: np.ndarray, order: int) -> np.ndarray:
    """The n-gram with the last two symbols of its context first, so that those of a bucket are sorted side by side."""
    front = gram >> (3 * BITS)
    return (((gram >> BITS) & mask(2)) << (BITS * (order - 2))) | (front << BITS) | (gram & mask(1))


def _turned_back(key: np.ndarray, order: int) -> np.ndarray:
    pair, front = key >> (BITS * (order - 2)), (key >> BITS) & mask(order - 3)
    return (front << (3 * BITS)) | (pair << BITS) | (key & mask(1))


def _rows(k: list[int], kind: int, chunk: int, data: list[bytes], lengths: bytes | None = None) -> pa.RecordBatch:
    n = len(k)
    arrays = [pa.array(k, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array([chunk] * n, pa.int64()), pa.array(data, pa.binary()), pa.array([lengths] * n, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["k", "kind", "chunk", "data", "lengths"])


ROWS = "k int, kind int, chunk long, data binary, lengths binary"


def _model_rows(tables: Tables, shards: int, copies: int) -> DataFrame:
    """The counts in rows by shard, once for each copy of the shard."""
    number = {name: i for i, name in enumerate(tables.names)}

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def close() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(waiting).combine_chunks()
            gram, n = table.column("gram").to_numpy(), table.column("n").to_numpy()
            model = np.array([number[x] for x in table.column("model").to_pylist()])
            group = (table.column("bucket").to_numpy() % shards).astype(np.int64) * len(number) + model
            by = np.lexsort((gram, group))
            gram, n, group = gram[by], n[by], group[by]
            starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            for a, b in zip(starts, [*starts[1:], len(group)], strict=True):
                shard, i = divmod(int(group[a]), len(number))
                for at in range(a, b, PIECE):
                    data = _packed(np.diff(gram[at : min(b, at + PIECE)], prepend=0), n[at : min(b, at + PIECE)].astype(np.int64))
                    yield _rows([shard * copies + c for c in range(copies)], MODEL, i, [data] * copies)

        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= 400_000:
                yield from close()
                waiting = []
        if waiting:
            yield from close()

    return tables.counts.mapInArrow(run, ROWS)


def _text_rows(df: DataFrame, text: str, order: int, table: Callable[[], np.ndarray], shards: int, copies: int) -> DataFrame:
    """For each chunk and shard its n-grams, how often each occurs, and gaps between the numbers of the texts where it does.

    A chunk has each different text once, by rising mean symbol: texts of a language lie together, and gaps are small.
    """

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_symbol, chunk = table(), TaskContext.get().partitionId() << 32
        keys: list[np.ndarray] = []
        digests: list[bytes] = []
        met: set[bytes] = set()
        held = 0

        def close() -> Iterator[pa.RecordBatch]:
            by = np.argsort([(x & mask(1)).mean() if len(x) else 0.0 for x in keys], kind="stable")
            lengths = np.array([len(keys[i]) for i in by], np.int64)
            key, at = np.empty(lengths.sum(), np.int64), 0
            for i, n in zip(by, lengths.tolist(), strict=True):
                key[at : at + n] = keys[i]
                keys[i], at = None, at + n
            copy = chunk % copies
            yield _rows([chunk % shards * copies + copy], HEAD, chunk, [b"".join([digests[i] for i in by])], lengths.tobytes())
            keys.clear()
            if not len(key):
                return
            by = np.argsort(key, kind="stable")
            key, owner = key[by], np.repeat(np.arange(len(lengths), dtype=np.uint16), lengths)[by]
            del by
            shard = np.empty(len(key), np.uint16)
            for a in range(0, len(key), BLOCK):
                shard[a : a + BLOCK] = bucket_of(key[a : a + BLOCK] >> (BITS * (order - 2))) % shards
            if shards > 1:
                by = np.argsort(shard, kind="stable")
                key, owner, shard = key[by], owner[by], shard[by]
                del by
            first = np.concatenate([[True], key[1:] != key[:-1]])
            gap = owner.copy()
            gap[1:] -= np.where(first[1:], np.uint16(0), owner[:-1])
            starts = np.flatnonzero(first)
            times = np.diff(np.append(starts, len(key)))
            grams_met, of = key[starts], shard[starts]
            cuts = np.flatnonzero((of[1:] != of[:-1]) | (starts[1:] // PIECE != starts[:-1] // PIECE)) + 1
            at, data = [], []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(starts)], strict=True):
                end = starts[b] if b < len(starts) else len(key)
                data.append(_packed(np.diff(grams_met[a:b], prepend=0), times[a:b].astype(np.uint32), gap[starts[a] : end]))
                at.append(int(of[a]) * copies + copy)
                if len(at) == 100:
                    yield _rows(at, TEXT, chunk, data)
                    at, data = [], []
            if at:
                yield _rows(at, TEXT, chunk, data)

        for batch in pieces(batches):
            for value, name in zip(text_list(batch.column("text")), batch.column("digest").to_pylist(), strict=True):
                if name in met:
                    continue
                met.add(name)
                keys.append(_turned(grams(symbols(codepoints(value), to_symbol), order), order))
                digests.append(name)
                held += len(keys[-1])
                if held >= HELD or len(keys) == TEXTS:
                    yield from close()
                    keys, digests, held = [], [], 0
                    met.clear()
                    chunk += 1
        if digests:
            yield from close()

    short_batches(df.sparkSession)
    return df.select(F.col(text).alias("text"), digest(text).alias("digest")).mapInArrow(run, ROWS)


def _shares(rows: DataFrame, tables: Tables) -> DataFrame:
    """(chunk, head, data, lengths): for each chunk and shard the sums of its texts, and each chunk's head as it is."""
    names, off, low, order = tables.names, tables.discounts, tables.low, tables.order
    width = len(names)

    def made(parts: list[list[tuple[np.ndarray, np.ndarray]]]) -> list[SortedModel]:
        out = []
        for i in range(width):
            own, parts[i] = parts[i], []
            levels = [merged(np.concatenate([g for g, _ in own]), np.concatenate([n for _, n in own]).astype(np.float64)) if own else (np.zeros(0, np.int64), np.zeros(0))]
            for k in range(order - 1, 2, -1):
                levels.insert(0, merged(np.sort(levels[0][0] & mask(k)), np.ones(len(levels[0][0]))))
            model = SortedModel(list(low[i].grams), list(low[i].logp), list(low[i].contexts), list(low[i].weight), low[i].floor)
            del own
            for d in off[i]:
                extend(model, *levels.pop(0), d)
            out.append(model)
        return out

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, models, parts = None, None, [[] for _ in names]
        last, total = None, np.zeros((0, width))

        def row(chunk: int, head: bool, data: bytes, lengths: bytes | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([head]), pa.array([data], pa.binary()), pa.array([lengths], pa.binary())], names=["chunk", "head", "data", "lengths"])

        for batch in batches:
            for k, kind, chunk, i in zip(batch.column("k").to_pylist(), batch.column("kind").to_pylist(), batch.column("chunk").to_pylist(), range(batch.num_rows), strict=True):
                if (k, chunk) != last or kind == MODEL:
                    if len(total):
                        yield row(last[1], False, total.astype(np.float32).tobytes(), None)
                    last, total = (k, chunk), np.zeros((0, width))
                if k != place:
                    place, models, parts = k, None, [[] for _ in names]
                data = batch.column("data")[i].as_py()
                if kind == HEAD:
                    yield row(chunk, True, data, batch.column("lengths")[i].as_py())
                elif kind == MODEL:
                    gaps, n = _unpacked(data)
                    parts[chunk].append((np.cumsum(gaps.view(np.int64)), n.view(np.int64)))
                else:
                    if models is None:
                        models, parts = made(parts), []
                    gaps, times, gap = _unpacked(data)
                    asked, times = _turned_back(np.cumsum(gaps.view(np.int64)), order), times.astype(np.int64)
                    reached, begin = np.cumsum(gap, dtype=np.int64), np.concatenate([[0], np.cumsum(times)[:-1]])
                    text = reached - np.repeat(reached[begin] - gap[begin], times)
                    high = int(text.max()) + 1
                    if high > len(total):
                        total = np.concatenate([total, np.zeros((high - len(total), width))])
                    for j, model in enumerate(models):
                        total[:high, j] += np.bincount(text, weights=np.repeat(model.score(asked).astype(np.float64), times), minlength=high)
        if len(total):
            yield row(last[1], False, total.astype(np.float32).tobytes(), None)

    return rows.mapInArrow(run, "chunk long, head boolean, data binary, lengths binary")


def sums(df: DataFrame, tables: Tables, table: Callable[[], np.ndarray], text: str = "text") -> DataFrame:
    """(digest, symbols, totals): for each different text its number of n-grams and the sum of their log probabilities by model.

    Equal texts have one row. Null is an empty text, with 0 symbols. Shards grow in number with the count tables; each
    is copied so often that all cores have work, and a chunk meets one copy of each. Four partitions for each of them
    leave few with more than one.
    """
    width = len(tables.names)
    shards = min(BUCKETS, max(1, -(-tables.size // GRAMS)))
    tasks = max(2 * df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions() // 8)
    copies = max(1, -(-tasks // shards))
    asked = _text_rows(df, text, tables.order, table, shards, copies)
    met = _model_rows(tables, shards, copies).unionByName(asked).repartition(4 * shards * copies, "k").sortWithinPartitions("k", "kind", "chunk")

    def whole(rows: pa.Table) -> dict:
        head = int(np.flatnonzero(rows.column("head").to_numpy())[0])
        digests, lengths = rows.column("data")[head].as_py(), np.frombuffer(rows.column("lengths")[head].as_py(), np.int64)
        total = np.zeros((len(lengths), width))
        for i, data in enumerate(rows.column("data").to_pylist()):
            if i != head:
                part = np.frombuffer(data, np.float32).reshape(-1, width)
                total[: len(part)] += part
        names, vectors = np.empty(len(lengths), object), np.empty(len(lengths), object)
        for i in range(len(lengths)):
            names[i], vectors[i] = digests[16 * i : 16 * i + 16], total[i].tolist()
        return {"digest": names, "symbols": lengths, "totals": vectors}

    schema = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("symbols", T.LongType()), T.StructField("totals", T.ArrayType(T.DoubleType()))])
    return cut(each_group(_shares(met, tables), "chunk", whole, schema).dropDuplicates(["digest"]))
