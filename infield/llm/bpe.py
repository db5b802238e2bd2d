"""Byte-level BPE encoding and decoding by monoid tree reduction.

The encodings of byte strings form a monoid under "encode the concatenation". A piece of text is halved down to
a few bytes, the leaves are merged directly, and neighbours are joined going up. Joining re-encodes a window
around the seam that grows until both of its outer seams are settled: a sequence of tokens is the encoding of
its bytes exactly if each adjacent pair of tokens is the encoding of the pair's bytes, so nothing outside a
window with settled seams can change. Decoding concatenates the tokens' bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from infield.llm.common import text_list, transform_batches

LEAF = 8  #: bytes that are merged directly
CACHED_BYTES, CACHED_PIECES = 64, 200_000  #: pieces up to this length are remembered, this many in a task
STREAMED = 1_000_000  #: texts over this many characters are cut into pieces bit by bit


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file: a line holds a token in base 64 and its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class TreeEncoder:
    """Encodes pieces of text under fixed ranks; remembers settled seams and short pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.seams: dict[tuple[int, int], bool] = {}
        self.nodes: dict[bytes, tuple[int, ...]] = {}
        self.windows: dict[tuple[int, ...], tuple[int, ...]] = {}

    def merge(self, data: bytes) -> tuple[int, ...]:
        """The encoding by definition: merge the adjacent pair of lowest rank, leftmost first, while there is one."""
        ranks = self.ranks
        n = len(data)
        if n <= 24:
            parts = [data[i : i + 1] for i in range(n)]
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    rank = ranks.get(parts[i] + parts[i + 1])
                    if rank is not None and (best is None or rank < best):
                        best, at = rank, i
                if at < 0:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            return tuple(ranks[p] for p in parts)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or end[j] - i != size:
                continue
            end[i], alive[j], after[i] = end[j], False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get(data[i : end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]] - i))
            if (h := before[i]) >= 0 and (r := ranks.get(data[h : end[i]])) is not None:
                heapq.heappush(heap, (r, h, end[i] - h))
        return tuple(ranks[data[i : end[i]]] for i in range(n) if alive[i])

    def settled(self, a: int, b: int) -> bool:
        """Whether token ``b`` after token ``a`` is the encoding of their bytes."""
        known = self.seams.get((a, b))
        if known is None:
            if len(self.seams) > CACHED_PIECES:
                self.seams.clear()
            known = self.seams[a, b] = self.merge(self.tokens[a] + self.tokens[b]) == (a, b)
        return known

    def window(self, ids: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the bytes of ``ids``; short ones are remembered."""
        known = self.windows.get(ids)
        if known is None:
            known = self.merge(b"".join([self.tokens[t] for t in ids]))
            if len(ids) <= 4:
                if len(self.windows) > CACHED_PIECES:
                    self.windows.clear()
                self.windows[ids] = known
        return known

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        if not left or not right:
            return left or right
        if self.settled(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self.window(left[-i:] + right[:j])
            open_left = i < len(left) and not self.settled(left[-i - 1], window[0])
            open_right = j < len(right) and not self.settled(window[-1], right[j])
            if not open_left and not open_right:
                return left[: len(left) - i] + window + right[j:]
            if open_left:
                i = min(len(left), 2 * i)
            if open_right:
                j = min(len(right), 2 * j)

    def reduce(self, data: bytes) -> tuple[int, ...]:
        if len(data) <= LEAF:
            known = self.nodes.get(data)
            if known is None:
                if len(self.nodes) > CACHED_PIECES:
                    self.nodes.clear()
                known = self.nodes[data] = self.merge(data)
            return known
        half = len(data) // 2
        return self.join(self.reduce(data[:half]), self.reduce(data[half:]))

    def piece(self, text: str) -> tuple[int, ...]:
        data = text.encode("utf-8", "replace")
        whole = self.ranks.get(data)  # a piece that is a token is that token
        return (whole,) if whole is not None else self.reduce(data)


class PieceCache(dict):
    """Encodings of the short pieces met so far in a task."""

    def __init__(self, encoder: TreeEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, text: str) -> tuple[int, ...]:
        ids = self.encoder.piece(text)
        if len(text) <= CACHED_BYTES:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[text] = ids
        return ids


_caches: dict[str, PieceCache] = {}  #: of a Python worker, kept from task to task; bounded by CACHED_PIECES


def worker_cache(name: str) -> PieceCache:
    path = SparkFiles.get(name)
    if path not in _caches:
        _caches[path] = PieceCache(TreeEncoder(read_ranks(path)))
    return _caches[path]


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with ``ids``, the tokens (array of int) of the whole of each ``text``; null and '' have none.

    Each match of ``pattern`` is encoded separately, without special tokens. Rows stay as they are, repeated ones
    and extra columns included; an input column named ``ids`` is replaced. The ranks go to the executors with
    Spark's file distribution: the vocabulary is fixed, a few MB.
    """
    spark = df.sparkSession
    spark.sparkContext.addFile(ranks_path)
    name = ranks_path.rsplit("/", 1)[-1]

    def make():
        lookup = worker_cache(name).__getitem__
        pieces = regex.compile(pattern)

        def tokens(value: str) -> np.ndarray:
            if len(value) <= STREAMED:
                return np.fromiter(chain.from_iterable(map(lookup, pieces.findall(value))), np.int32)
            matches = (m.group() for m in pieces.finditer(value))
            parts = []
            while some := list(islice(matches, 100_000)):
                parts.append(np.fromiter(chain.from_iterable(map(lookup, some)), np.int32))
            return np.concatenate(parts)

        def fn(column: pa.Array) -> list[pa.Array]:
            rows = [tokens(t) for t in text_list(column)]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32)))]

        return fn

    return transform_batches(df, [text], T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType(), True))]), make)


class Spelling:
    """Fixed byte strings by number, for joining the strings of many numbers at once."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.flat = np.frombuffer(b"".join(strings), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return b""
        at = np.arange(ends[-1]) + np.repeat(self.start[ids] - (ends - size), size)
        return self.flat[at].tobytes()


def vocabulary_spelling(name: str) -> Spelling:
    """The tokens of a vocabulary by id; an id that is left out stands for no bytes."""
    tokens = {i: t for t, i in read_ranks(SparkFiles.get(name)).items()}
    return Spelling([tokens.get(i, b"") for i in range(max(tokens) + 1)])


def id_rows(column: pa.ListArray) -> list[np.ndarray]:
    """The ids of each row; null has none."""
    if column.null_count:
        column = column.fill_null([])
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", data: str = "decoded") -> DataFrame:
    """``df`` with ``data``, the bytes that ``ids`` stand for: concatenation up the tree, done for a row at once.

    A null or empty list gives no bytes. An id that is not in the vocabulary is an error.
    """
    df.sparkSession.sparkContext.addFile(ranks_path)
    name = ranks_path.rsplit("/", 1)[-1]

    def make():
        spelling = vocabulary_spelling(name)

        def fn(column: pa.Array) -> list[pa.Array]:
            return [pa.array([spelling.joined(r) for r in id_rows(column)], pa.binary())]

        return fn

    return transform_batches(df, [ids], T.StructType([T.StructField(data, T.BinaryType(), True)]), make)


def digests(df: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 (of decode's bytes) for each row."""
    df.sparkSession.sparkContext.addFile(ranks_path)
    name = ranks_path.rsplit("/", 1)[-1]
    out = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def make():
        spelling = vocabulary_spelling(name)
        numbers = Spelling([b"%d," % i for i in range(len(spelling.size))])

        def fn(column: pa.Array) -> list:
            rows = id_rows(column)
            return [
                [len(r) for r in rows],
                [hashlib.sha256(numbers.joined(r)[:-1]).hexdigest() for r in rows],
                [hashlib.sha256(spelling.joined(r)).hexdigest() for r in rows],
            ]

        return fn

    return transform_batches(df, [ids], out, make)
