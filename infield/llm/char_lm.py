"""Character n-grams packed into 64-bit integers, and interpolated modified Kneser-Ney models over them.

A symbol is a character folded to 12 bits, so five symbols fit a non-negative long: the last symbol lies in the
lowest bits, ``gram >> 12`` is the context and ``gram & mask`` a suffix, in numpy and in Spark alike. Characters
beyond the first 4,096 code points share symbols; that loses nothing but sharpness.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from infield.llm.common import mix, pieces, short_batches, tidy

BITS = 12
SPACE = 32


def mask(order: int) -> int:
    return (1 << (BITS * order)) - 1


BUCKETS = 4096  #: that n-grams are dealt to, by the last two symbols of their context


def bucket_of(pairs: np.ndarray) -> np.ndarray:
    """The bucket of each pair of symbols."""
    return (mix(pairs.astype(np.uint64) + np.uint64(1)) % np.uint64(BUCKETS)).astype(np.int32)


_tables: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """Symbol of each code point: lower-case letters are themselves, folded; all else is a space."""
    if "letters" not in _tables:
        table = np.full(0x110000, SPACE, np.uint16)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                folded = ord(low[0]) if low else cp
                table[cp] = folded if folded < 4096 else 4096 - 1 - folded % 2048
        _tables["letters"] = table
    return _tables["letters"]


def raw_table() -> np.ndarray:
    """Symbol of each code point for text as it is written: digits are one symbol, white space another."""
    if "raw" not in _tables:
        cp = np.arange(0x110000)
        table = np.where(cp < 4096, cp, 4095 - cp % 2048).astype(np.uint16)
        table[48:58] = 48
        for c in "\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　":
            table[ord(c)] = SPACE
        _tables["raw"] = table
    return _tables["raw"]


def symbols(cps: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Symbols of a text, with one space before it and one for each run of spaces."""
    found = np.empty(len(cps) + 1, np.uint16)
    found[0] = SPACE
    found[1:] = table[np.minimum(cps, 0x10FFFF)]
    space = found == SPACE
    keep = ~space
    keep[0] = True
    keep[1:] |= ~space[:-1]
    return found[keep].astype(np.int64)


def grams(syms: np.ndarray, order: int) -> np.ndarray:
    """Packed n-grams that end in each symbol after the first; the text's start is padded with spaces."""
    n = len(syms)
    padded = np.concatenate([np.full(order - 2, SPACE, np.int64), syms]) if order > 2 else syms
    out = np.zeros(n - 1, np.int64)
    for k in range(order):
        out = (out << BITS) | padded[k : k + n - 1]
    return out


class Counter:
    """Counts of integers met in a stream, merged as they come; a bounded number is held before compaction."""

    def __init__(self, held: int = 1_500_000):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.held = 0, held

    def add(self, values: np.ndarray) -> None:
        keys, n = np.unique(values, return_counts=True)
        self.parts.append((keys, n))
        self.size += len(keys)
        if self.size > self.held:
            self.compact()

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        n = np.concatenate([c for _, c in self.parts])
        self.parts = []
        by = np.argsort(keys, kind="stable")
        keys = keys[by]
        n = n[by]
        del by
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        merged = keys[first], np.add.reduceat(n, first) if len(keys) else n
        self.parts, self.size = [merged], len(first)
        return merged


MOST = 2_000_000  #: counts that a task holds, about, before it sends the largest models' on


def count_grams(df: DataFrame, model: str, text: str, order: int, table: Callable[[], np.ndarray]) -> DataFrame:
    """(bucket, model, gram, n): how often each n-gram occurs in all texts of a model. Counted in each task, then added up."""
    src = df.select(F.col(model).cast("string").alias("model"), F.col(text).alias("text"))

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}
        to_symbol = table()

        def flush(names: Iterable[str]) -> Iterator[pa.RecordBatch]:
            for name in names:
                keys, n = counters.pop(name).compact()
                for a in range(0, len(keys), 200_000):
                    k = keys[a : a + 200_000]
                    yield pa.RecordBatch.from_arrays([pa.array(bucket_of((k >> BITS) & mask(2))), pa.array([name] * len(k), pa.string()), pa.array(k, pa.int64()), pa.array(n[a : a + 200_000].astype(np.int64))], names=["bucket", "model", "gram", "n"])

        for batch in pieces(batches):
            found: dict[str, list[np.ndarray]] = {}
            size = 0
            for name, value in zip(batch.column("model").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if name is not None and value:
                    made = grams(symbols(np.frombuffer(value.encode("utf-32-le", "surrogatepass"), "<u4"), to_symbol), order)
                    found.setdefault(name, []).append(made)
                    size += len(made)
                    if size > 500_000:
                        for key, parts in found.items():
                            counters.setdefault(key, Counter()).add(np.concatenate(parts))
                        found, size = {}, 0
            for key, parts in found.items():
                counters.setdefault(key, Counter()).add(np.concatenate(parts))
            if sum(c.size for c in counters.values()) > MOST:  # of all models together: there may be many
                for c in counters.values():
                    c.compact()
                while sum(c.size for c in counters.values()) > MOST // 2:
                    yield from flush([max(counters, key=lambda k: counters[k].size)])
        yield from flush(list(counters))

    short_batches(df.sparkSession)
    made = src.mapInArrow(run, "bucket int, model string, gram long, n long")
    return made.groupBy("bucket", "model", "gram").agg(F.sum("n").alias("n"))


def discounts(by_count: dict[int, int]) -> tuple[float, float, float]:
    """The modified Kneser-Ney discounts of n-grams met once, twice and more often; by_count: n-grams by count 1 to 4."""
    n1, n2, n3, n4 = (by_count.get(i, 0) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in enumerate(found, 1))


class SortedModel:
    """A model as sorted arrays: for each order the n-grams with their log probabilities, contexts with log weights.

    grams[k], logp[k]: seen n-grams of order k + 1; contexts[k], weight[k]: their contexts' back-off weights.
    """

    def __init__(self, grams: list[np.ndarray], logp: list[np.ndarray], contexts: list[np.ndarray], weight: list[np.ndarray], floor: float):
        self.grams, self.logp, self.contexts, self.weight, self.floor = grams, logp, contexts, weight, floor

    @staticmethod
    def find(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, missing: float) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.full(len(asked), missing, np.float32), np.zeros(len(asked), bool)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        hit = keys[at] == asked
        return np.where(hit, values[at], np.float32(missing)), hit

    def score(self, asked: np.ndarray, order: int | None = None) -> np.ndarray:
        """Log probability of the last symbol of each n-gram after its context. Fastest where ``asked`` is sorted."""
        k = (order or len(self.grams)) - 1
        out, hit = self.find(self.grams[k], self.logp[k], asked, 0.0)
        if not hit.all():
            miss = ~hit
            rest = asked[miss]
            weight, _ = self.find(self.contexts[k], self.weight[k], rest >> BITS, 0.0)
            out[miss] = weight + (self.floor if k == 0 else self.score(rest & mask(k), k))
        return out


def extend(model: SortedModel, g: np.ndarray, n: np.ndarray, d: tuple[float, float, float]) -> None:
    """Adds the next order to ``model``: its sorted n-grams, their counts and the discounts of counts 1, 2 and more."""
    k = len(model.grams)
    off = np.array([0.0, *d])[np.minimum(n, 3).astype(int)]
    context = g >> BITS
    first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(g) else np.zeros(0, int)
    total = np.add.reduceat(n, first) if len(g) else n
    freed = np.add.reduceat(off, first) if len(g) else n
    spread = np.diff(np.concatenate([first, [len(g)]]))
    gamma = freed / np.maximum(total, 1e-12)
    lower = np.exp(model.floor) if k == 0 else np.exp(model.score(g & mask(k), k).astype(np.float64))
    p = (n - off) / np.repeat(total, spread) + np.repeat(gamma, spread) * lower
    model.grams.append(g)
    model.logp.append(np.log(p).astype(np.float32))
    model.contexts.append(context[first])
    model.weight.append(np.log(gamma).astype(np.float32))


def fit(keys: np.ndarray, counts: np.ndarray, order: int) -> SortedModel:
    """Interpolated modified Kneser-Ney from the counts of the highest order, in one process: for small models."""
    levels = [merged(keys, counts.astype(np.float64))]
    for k in range(order - 1, 0, -1):  # lower orders count the different symbols that come before
        levels.insert(0, merged(levels[0][0] & mask(k), np.ones(len(levels[0][0]))))
    model = SortedModel([], [], [], [], -float(np.log(max(len(levels[0][0]), 1) + 1.0)))
    for g, n in levels:
        extend(model, g, n, discounts({i: int((n == i).sum()) for i in (1, 2, 3, 4)}))
    return model


def merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys, and the sums of their numbers."""
    if not len(keys):
        return keys.astype(np.int64), n
    by = np.argsort(keys, kind="stable")
    keys, n = keys[by], n[by]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)
