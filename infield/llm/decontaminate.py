"""Benchmark decontamination by latent semantic retrieval.

Benchmark texts are cut into passages. Words are weighted by TF-IDF, with document frequencies from all documents.
A distributed randomised SVD of the passages gives a latent space; stretches of documents with several rare words
of the benchmark are folded into it and compared with all passages by cosine. Every candidate is checked on the
words themselves: the longest common subsequence of the whole benchmark text, or of a passage of a longer one, and the
stretch around the match, and for paraphrases whether the answer, the text's last sentence, is there too.

Large benchmarks are worked off in slices, so that what goes to the executors is bounded by SLICE.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from infield.llm.common import WordHasher, mix, tidy, transform_batches

SLICE = 10_000_000  #: characters of benchmark text that are searched for at once
PASSAGE, STRIDE = 32, 16  #: words
RANK, EXTRA = 256, 16  #: dimensions of the latent space, and those the sketch has besides
COSINE = 0.4  #: of candidates
COPIED = 0.6  #: share of a benchmark text's words that a copy has in order
REWORDED, ANSWERED = 0.4, 0.75  #: the same for a paraphrase, and the share of the answer's words that it has
NEAR = 0.55  #: cosine of a paraphrase
PART, PART_WORDS = 0.85, 24  #: share of a passage's words in order that tells a copy of part of a longer text, and words of such a passage at least
TOLD = 0.5  #: share of a benchmark text's words, by inverse document frequency, that must be there in any order


def words_of(texts: list[str]) -> list[np.ndarray]:
    """Word hashes of each text."""
    out: list[np.ndarray] = []
    for _, hashes, offsets in WordHasher()(pa.array(texts, pa.string())):
        out += [hashes[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
    return out


def answer_of(text: str) -> str:
    """The last sentence of a text, or its last third if it is one sentence."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s]
    if len(sentences) > 1:
        return sentences[-1]
    tokens = text.split()
    return " ".join(tokens[-max(1, len(tokens) // 3) :])


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, all of ``a`` at once in the bits of an integer."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for y in b:
        match = row & at.get(y, 0)
        row = (row + match | row - match) & full
    return len(a) - row.bit_count()


@dataclass
class Benchmark:
    """One slice of the benchmark, ready to be searched for."""

    items: list[int]
    words: list[list[int]]
    answers: list[set[int]]
    vocabulary: np.ndarray  #: sorted word hashes
    idf: np.ndarray
    basis: np.ndarray  #: words by latent dimensions
    weights: list[dict[int, float]] = field(default_factory=list)  #: of each item's words
    totals: list[float] = field(default_factory=list)  #: sums of the weights
    passages: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.float32))  #: unit vectors
    owner: np.ndarray = field(default_factory=lambda: np.zeros(0, int))  #: item of each passage
    start: np.ndarray = field(default_factory=lambda: np.zeros(0, int))  #: its first word there
    rare: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))  #: words that make a stretch worth a look
    needed: int = 3  #: rare words in a stretch


def passage_bounds(n: int) -> list[tuple[int, int]]:
    if n <= PASSAGE:
        return [(0, n)] if n else []
    starts = list(range(0, n - PASSAGE, STRIDE)) + [n - PASSAGE]
    return [(s, s + PASSAGE) for s in starts]


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many of all documents each word occurs, and the number of documents."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hasher, rows = Lookup(sent.value), WordHasher(), 0
        found = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            rows += batch.num_rows
            for _, hashes, offsets in hasher(batch.column("text")):
                at, column = known(hashes)
                row = np.searchsorted(offsets, at, side="right")
                pairs = np.unique(row.astype(np.int64) * len(found) + column)
                found += np.bincount(pairs % len(found), minlength=len(found))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *some], pa.int64()), pa.array([rows, *found[some]], pa.int64())], names=["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out, total = np.zeros(len(vocabulary)), 0
    for r in rows:
        if r.word < 0:
            total = r.n
        else:
            out[r.word] = r.n
    return out, total


class Lookup:
    """Positions of known words in a sequence of hashes, and which they are; most others fail a small table first."""

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary = vocabulary
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[vocabulary >> np.uint64(44)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(44)])
        if not len(self.vocabulary):
            return at[:0], at[:0]
        column = np.minimum(np.searchsorted(self.vocabulary, hashes[at]), len(self.vocabulary) - 1)
        hit = self.vocabulary[column] == hashes[at]
        return at[hit], column[hit]


def latent_basis(passages: DataFrame, width: int) -> np.ndarray:
    """The right singular vectors of the sparse rows ``passages`` (columns, weights), by a distributed randomised SVD.

    Y = A W for a random W that is hashed from column numbers; Y'Y is added up over the rows and gives the
    factor that makes Y orthonormal, Q; B = Q'A is added up column by column; the small SVD of B ends it.
    """
    dims = min(RANK + EXTRA, width)

    def projected(columns: list, weights: list) -> np.ndarray:
        out = np.zeros((len(columns), dims))
        salt = mix(np.arange(1, dims + 1, dtype=np.uint64))
        for i, (c, w) in enumerate(zip(columns, weights, strict=True)):
            drawn = mix(np.asarray(c, np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) ^ salt)
            out[i] = np.asarray(w) @ (drawn.astype(np.float64) / 2.0**63 - 1.0)
        return out

    def gram(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            y = projected(batch.column("columns").to_pylist(), batch.column("weights").to_pylist())
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int64()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["key", "vector"])

    def added(df: DataFrame) -> DataFrame:
        return df.groupBy("key").agg(Summarizer.sum(array_to_vector("vector")).alias("v")).select("key", vector_to_array("v").alias("vector"))

    both = np.zeros((dims, dims))
    for r in added(passages.mapInArrow(gram, "key long, vector array<double>")).collect():
        both[r.key] = r.vector
    values, vectors = np.linalg.eigh(both)
    use = values > values.max(initial=0) * 1e-10
    whiten = vectors[:, use] / np.sqrt(values[use])

    def reduced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, weights = batch.column("columns").to_pylist(), batch.column("weights").to_pylist()
            q = projected(columns, weights) @ whiten
            flat = np.concatenate([np.asarray(c, np.int64) for c in columns]) if columns else np.zeros(0, np.int64)
            scaled = np.concatenate([np.asarray(w)[:, None] * q[i] for i, w in enumerate(weights)]) if columns else np.zeros((0, use.sum()))
            key, inverse = np.unique(flat, return_inverse=True)
            total = np.zeros((len(key), scaled.shape[1]))
            np.add.at(total, inverse, scaled)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["key", "vector"])

    b = np.zeros((width, int(use.sum())))
    for r in added(passages.mapInArrow(reduced, "key long, vector array<double>")).toLocalIterator():
        b[r.key] = r.vector
    values, vectors = np.linalg.eigh(b.T @ b)
    top = np.argsort(values)[::-1][:RANK]
    top = top[values[top] > values.max(initial=0) * 1e-10]
    return (b @ vectors[:, top] / np.sqrt(values[top])).astype(np.float32)


def prepare(docs: DataFrame, items: DataFrame) -> Benchmark | None:
    """A slice of the benchmark (item_id, text) with its latent space; None if it has no words."""
    rows = sorted((r for r in items.select("item_id", "text").collect() if r.item_id is not None), key=lambda r: (r.item_id, r.text or ""))
    words = words_of([r.text or "" for r in rows])
    keep = [i for i, w in enumerate(words) if len(w)]
    if not keep:
        return None
    rows, words = [rows[i] for i in keep], [words[i] for i in keep]
    vocabulary = np.unique(np.concatenate(words))
    seen, total = document_frequencies(docs, vocabulary)
    idf = np.log((total + 1) / (seen + 1)) + 0.1
    answers = words_of([answer_of(r.text) for r in rows])
    out = Benchmark([r.item_id for r in rows], [w.tolist() for w in words], [set(a.tolist()) for a in answers], vocabulary, idf.astype(np.float32), np.zeros((len(vocabulary), 1), np.float32))
    sparse, owner, start = [], [], []
    for i, w in enumerate(words):
        column = np.searchsorted(vocabulary, w)
        for a, b in passage_bounds(len(w)):
            c, n = np.unique(column[a:b], return_counts=True)
            sparse.append((c.tolist(), (n * idf[c]).tolist()))
            owner.append(i)
            start.append(a)
    out.weights = [dict(zip(w.tolist(), idf[np.searchsorted(vocabulary, w)].tolist(), strict=True)) for w in words]
    out.totals = [sum(w.values()) for w in out.weights]
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("columns", T.ArrayType(T.LongType())), T.StructField("weights", T.ArrayType(T.DoubleType()))])
    table = pa.table({"columns": pa.array([s[0] for s in sparse], pa.list_(pa.int64())), "weights": pa.array([s[1] for s in sparse], pa.list_(pa.float64()))})
    passages = spark.createDataFrame(table, schema).repartition(max(1, len(sparse) // 5000))
    out.basis = latent_basis(passages, len(vocabulary))
    latent = np.stack([np.asarray(w, np.float32) @ out.basis[c] for c, w in sparse])
    out.passages = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    out.owner, out.start = np.array(owner), np.array(start)
    # The rarest third of each passage's words, six at least, make a stretch worth a look where half of six meet.
    out.rare = np.zeros(len(vocabulary), bool)
    for c, _ in sparse:
        c = np.array(c)
        out.rare[c[np.argsort(-idf[c], kind="stable")[: max(6, len(c) // 3)]]] = True
    out.needed = min(3, *(-(-len(c) // 2) for c, _ in sparse)) if sparse else 3
    return out


class Finder:
    """Finds the texts of one Benchmark in batches of documents."""

    def __init__(self, bench: Benchmark):
        self.b = bench
        self.hasher = WordHasher()
        self.known = Lookup(bench.vocabulary)
        self.rare = Lookup(bench.vocabulary[bench.rare])

    def __call__(self, column: pa.Array) -> list[tuple[int, int, float, float, int]]:
        """(row, item number, share of its words in order, cosine, first word) of each text found in each row."""
        best: dict[tuple[int, int], tuple[float, float, int]] = {}
        for first, hashes, offsets in self.hasher(column):
            for row, item, share, cosine, at in self.search(hashes, offsets):
                key = (first + row, item)
                if key not in best or share > best[key][0]:
                    best[key] = (share, cosine, at)
        return [(*k, *v) for k, v in sorted(best.items())]

    def search(self, hashes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, float, float, int]]:
        b = self.b
        at, _ = self.rare(hashes)
        if not len(at):
            return
        row = np.searchsorted(offsets, at, side="right") - 1
        end = np.minimum(at + PASSAGE, offsets[row + 1])
        enough = np.searchsorted(at, end) - np.arange(len(at)) >= b.needed
        at, row, end = at[enough], row[enough], end[enough]
        if not len(at):
            return
        _, first = np.unique(row.astype(np.int64) * (1 << 40) + (at - offsets[row]) // 6, return_index=True)
        at, row, end = at[first], row[first], end[first]
        inside, which = self.known(hashes)
        lo, hi = np.searchsorted(inside, at), np.searchsorted(inside, end)
        done: dict[tuple[int, int], int] = {}
        for part in range(0, len(at), 4096):
            some = slice(part, part + 4096)
            latent = np.stack([b.idf[which[i:j]] @ b.basis[which[i:j]] for i, j in zip(lo[some], hi[some], strict=True)])
            latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
            cosine = latent @ b.passages.T
            for k, p in zip(*np.nonzero(cosine >= COSINE), strict=True):
                item, r, s = int(b.owner[p]), int(row[part + k]), int(at[part + k])
                words = b.words[item]
                if done.get((r, item), -1) >= s:  # the stretch that was checked last reaches beyond this one
                    continue
                begin = max(int(offsets[r]), s - int(b.start[p]) - PASSAGE)
                stop = min(int(offsets[r + 1]), s + PASSAGE + len(words) - int(b.start[p]))
                stretch = hashes[begin:stop].tolist()
                there, weight = set(stretch), b.weights[item]
                passage = words[int(b.start[p]) : int(b.start[p]) + PASSAGE]
                if len(words) > len(passage) >= PART_WORDS and sum([w in there for w in passage]) >= PART * len(passage) and common_subsequence(passage, stretch) >= PART * len(passage):
                    done[r, item] = s + PASSAGE // 2
                    yield r, item, common_subsequence(words, stretch) / len(words), float(cosine[k, p]), begin - int(offsets[r])
                    continue
                if sum([weight[w] for w in there if w in weight]) < TOLD * b.totals[item]:
                    continue
                share = common_subsequence(words, stretch) / len(words)
                answer = b.answers[item]
                answered = len(answer & there) >= ANSWERED * len(answer)
                if share >= COPIED or share >= REWORDED and cosine[k, p] >= NEAR and answered:
                    done[r, item] = s + PASSAGE // 2
                    yield r, item, share, float(cosine[k, p]), begin - int(offsets[r])


def benchmarks(docs: DataFrame, items: DataFrame) -> Iterator[Benchmark]:
    """The slices of the benchmark: one, unless it has more than SLICE characters."""
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // SLICE))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        if (bench := prepare(docs, part)) is not None:
            yield bench


LEAK = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("cosine", T.DoubleType()),
        T.StructField("first_word", T.LongType()),
    ]
)


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each document (doc_id, text) and benchmark text (item_id, text) found in it.

    coverage is the share of the benchmark text's words that the document has in order, cosine that of the best
    stretch, first_word where the stretch begins. Null and empty texts have no leaks and are none. Items without an
    id are ignored, equal items are all reported. Repeated documents each get their rows; ties between stretches
    go to the first.
    """
    out = docs.sparkSession.createDataFrame([], LEAK)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for bench in benchmarks(docs, items):
        sent = docs.sparkSession.sparkContext.broadcast(bench)

        @tidy
        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            finder = Finder(sent.value)
            for batch in batches:
                found = finder(batch.column("text"))
                ids = batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([sent.value.items[f[1]] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.float64()), pa.array([f[4] for f in found], pa.int64())], names=LEAK.names)

        out = out.unionByName(source.mapInArrow(run, LEAK))
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark text is found."""
    for bench in benchmarks(docs, items):
        sent = docs.sparkSession.sparkContext.broadcast(bench)

        def make(sent=sent):
            finder = Finder(sent.value)

            def fn(column: pa.Array):
                keep = np.ones(len(column), bool)
                keep[[f[0] for f in finder(column)]] = False
                return [], keep

            return fn

        docs = transform_batches(docs, ["text"], T.StructType([]), make)
    return docs
