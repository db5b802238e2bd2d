"""N-gram Jaccard self-join of texts by chosen paths.

Texts are sets of hashed five-word shingles; equal sets form a class, of which one text goes on. Each set is
embedded as MinHash values, so that two sets share a fraction of values that is their similarity. In each of RUNS
independent runs a set walks down a tree: at each node it goes to the children of the values that the node's hash
function selects, 1 / THRESHOLD of them on average. Nodes of up to SMALL sets are compared by brute force; larger ones
are split further. Within a large node every set is first compared with one pivot, and leaves if it is nearly equal
to it: whatever is similar enough to it is then linked to the pivot, too.

What the tree finds are loose links, on MinHash values. Their components hold every text near another. All sets of
a component then meet, in pairs of bounded blocks, and the exact similarity decides: this counts each text's links
without emitting all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from infield.llm.common import MAX_BROADCAST_KEYS, Scratch, WordHasher, cut, each_group, mix, shingles, stored, tidy
from infield.llm.components import components

WIDTH = 5
THRESHOLD = 0.8
VALUES = 64  #: MinHash values of a set
#: A pair at the threshold shares a path of one run with probability 0.31 four levels down, the deepest a tree goes.
#: Averaged over the MinHash values that such pairs have, 20 runs find 0.9988 of them and 24 find 0.9996; the target is
#: 0.999. Pairs above the threshold, and those in nodes higher up, are found more often.
RUNS = 24
LEVELS = 4
#: Sets of a node that are compared by brute force, all with all: links that the tree might miss are found, too. A common
#: line puts thousands of sets into a node; each further level would cost rows that such a node's comparison saves.
SMALL = 2048
LOOSE = 0.6  #: share of equal values that makes a loose link; 4 standard deviations below the threshold
CLOSE = 0.9  #: share that makes a set leave a large node
PART = 1024  #: sets of a large node that meet its pivot in one task
BLOCK = 256  #: sets of a component that meet in one task


def _seeds(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, size, set_key, values, sketch): number of shingles, digest of their set, MinHash values and a byte of each.

    A text of fewer than five words has one shingle of them all; one without words has size 0 and no values.
    """

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHasher()
        factors, shift = _seeds(VALUES, 1) | np.uint64(1), np.uint64(32)
        for batch in batches:
            ids = batch.column("doc")
            for first, hashes, offsets in words(batch.column("text")):
                made, bounds = shingles(hashes, offsets, WIDTH)
                size, keys, packed, sketches = [], [], [], []
                for a, b in zip(bounds, bounds[1:], strict=False):
                    s = np.unique(made[a:b])
                    size.append(len(s))
                    if not len(s):
                        keys.append(None)
                        packed.append(None)
                        sketches.append(None)
                        continue
                    keys.append(int(s.sum(dtype=np.uint64)).to_bytes(8, "big") + int(np.bitwise_xor.reduce(mix(s + np.uint64(7)))).to_bytes(8, "big"))
                    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
                    for at in range(0, len(s), 4096):
                        np.minimum(least, (mix(s[at : at + 4096]) * factors[:, None]).min(axis=1), out=least)
                    packed.append((least >> shift).astype(np.uint32).view(np.int32))
                    sketches.append((least >> shift).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(size)), pa.array(size, pa.int64()), pa.array(keys, pa.binary()), pa.array(packed, pa.list_(pa.int32())), pa.array(sketches, pa.binary())], names=["doc", "size", "set_key", "values", "sketch"])

    return docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).mapInArrow(run, "doc long, size long, set_key binary, values array<int>, sketch binary")


def _values(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint32).reshape(-1, VALUES)


def _children(nodes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and node of each child that a set (a row of values) goes to from its node."""
    tokens = values.astype(np.uint64) * np.uint64(VALUES) + np.arange(VALUES, dtype=np.uint64)
    drawn = mix(mix(tokens) ^ nodes[:, None])
    chosen = drawn < np.uint64(int((1 << 64) / (THRESHOLD * VALUES)))
    row, at = np.nonzero(chosen)
    return row, mix(drawn[row, at] + nodes[row])


def descend(rows: DataFrame, first: bool) -> DataFrame:
    """(node, doc, values) of the next level from (node, doc, values), or of the first from (doc, values)."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = _seeds(RUNS, 99)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                values = _values(part.column("values"))
                starts = [np.full(len(values), r) for r in roots] if first else [part.column("node").to_numpy().view(np.uint64)]
                for nodes in starts:
                    row, child = _children(nodes, values)
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), part.column("doc").take(take)], names=["node", "doc"])

    return rows.mapInArrow(run, "node long, doc long")


def _roots(linked: np.ndarray) -> np.ndarray:
    """The least member of each one's component in a small symmetric matrix of links."""
    label = np.arange(len(linked), dtype=np.int32)
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], np.int32(len(label))).min(axis=1))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _agreeing(sketch: np.ndarray, one: np.ndarray) -> np.ndarray:
    """At how many places each row of bytes agrees with one, eight places at a time: VALUES are few enough for a byte."""
    words = (sketch == one).view(np.uint64)
    total = words[:, 0].copy()
    for k in range(1, words.shape[1]):
        total += words[:, k]
    return (total * np.uint64(0x0101010101010101)) >> np.uint64(56)


def _loose_links(table: pa.Table) -> dict | None:
    """A spanning forest of the sets of one small node whose sketches agree at LOOSE of their places."""
    docs = table.column("doc").to_numpy()
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, VALUES)
    by = np.argsort(docs)
    docs, sketch = docs[by], sketch[by]
    linked = np.zeros((len(docs), len(docs)), bool)
    for i in range(len(docs)):
        linked[i] = _agreeing(sketch, sketch[i]) >= LOOSE * VALUES
    root = _roots(linked)
    off = root != np.arange(len(docs))
    return {"a": docs[root[off]], "b": docs[off]} if off.any() else None


LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _listed(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if it has MAX_BROADCAST_KEYS rows at most."""
    return F.broadcast(df) if df.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS else df


def loose_links(sets: DataFrame) -> DataFrame:
    """(a, b): links of sets (doc, values, sketch) that the chosen-path tree finds."""
    with Scratch() as s:
        found = []
        rows = cut(descend(sets, True))
        for level in range(LEVELS):
            sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
            met = s.keep(rows.join(sizes, "node"))
            small, large = met.where(F.col("size") <= SMALL), met.where(F.col("size") > SMALL)
            found.append(each_group(small.join(sets.select("doc", "sketch"), "doc").select("node", "doc", "sketch"), "node", _loose_links, LINK))
            if large.isEmpty():
                break
            large = s.keep(sets.join(_listed(large), "doc"))
            beside = cut(beside_pivots(large))
            found.append(beside.where((F.col("share") >= LOOSE) & (F.col("doc") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("doc").alias("b")))
            rest = beside.where(F.col("share") < CLOSE)
            if level + 1 < LEVELS:
                rows = cut(descend(rest.select("node", "doc", "values"), False))
            else:  # what is left of large nodes is compared in pairs of blocks
                pairs = block_pairs(rest.select(F.col("node").alias("group"), F.col("size").alias("members"), "doc", "sketch"), SMALL // 2)
                found.append(each_group(pairs.withColumnRenamed("pair", "node"), "node", _loose_links, LINK))
        return cut(reduce(DataFrame.unionByName, found).distinct())


def beside_pivots(large: DataFrame) -> DataFrame:
    """Rows (node, size, doc, values and more) of large nodes with their node's pivot, the least doc, and share, that of equal values.

    A node's rows are dealt into parts of about PART by their id, and its pivot goes to each part ahead of them: however
    many sets a node holds, no task gets them all, and a part streams past its pivot.
    """
    pivots = large.groupBy("node").agg(F.min_by(F.struct("doc", "values"), "doc").alias("p"), F.first("size").alias("size"))
    parts = F.ceil(F.col("size") / PART).cast("int")
    first = pivots.select("node", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"), F.lit(0).alias("_turn"), "p.doc", "p.values")
    own = large.withColumns({"_part": F.pmod(F.xxhash64("doc"), parts).cast("int"), "_turn": F.lit(1)})
    dealt = own.unionByName(first, allowMissingColumns=True).repartition("node", "_part").sortWithinPartitions("node", "_part", "_turn")
    columns = large.columns
    schema = T.StructType([*large.schema.fields, T.StructField("pivot", T.LongType()), T.StructField("share", T.DoubleType())])

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, values = np.zeros(1, np.int64), np.zeros((1, VALUES), np.uint32)  # the last pivot of the batches before
        for batch in batches:
            if not batch.num_rows:
                continue
            docs = np.concatenate([doc, batch.column("doc").to_numpy()])
            rows = np.concatenate([values, _values(batch.column("values"))])
            leads = np.concatenate([[True], batch.column("_turn").to_numpy() == 0])
            at = np.maximum.accumulate(np.where(leads, np.arange(len(leads)), 0))
            doc, values = docs[at[-1:]], rows[at[-1:]]
            keep = np.flatnonzero(~leads)
            share = (rows[keep] == rows[at[keep]]).mean(axis=1) if len(keep) else np.zeros(0)
            take = pa.array(keep - 1)
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in columns], pa.array(docs[at[keep]]), pa.array(share)], names=schema.names)

    return dealt.mapInArrow(run, schema)


def block_pairs(rows: DataFrame, block: int) -> DataFrame:
    """Rows of each ``group`` of ``members`` dealt into blocks of about ``block``, each row once for each pair of blocks it is in.

    Adds pair (the pair's key), i and j (its blocks, i <= j) and own (the row's block).
    """
    sized = rows.withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    owned = sized.withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    dealt = owned.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).withColumn("pair", F.xxhash64("group", "i", "j")).drop("other", "blocks", "members")


TOKEN = 5  #: bytes of a shingle's hash in a packed set: in a pair of blocks two of them hardly ever coincide


def _packed(made: np.ndarray) -> bytes:
    return np.unique(made).view(np.uint8).reshape(-1, 8)[:, :TOKEN].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // TOKEN, 8), np.uint8)
    out[:, :TOKEN] = np.frombuffer(data, np.uint8).reshape(-1, TOKEN)
    return np.unique(out.view(np.uint64).ravel())


COUNTED = T.StructType([T.StructField("doc", T.LongType()), T.StructField("links", T.LongType()), T.StructField("root", T.LongType())])


def _exact_links(table: pa.Table) -> dict | None:
    """Number of partners of each linked set within one pair of blocks, and one set that links connect it with."""
    _, first = np.unique(table.column("doc").to_numpy(), return_index=True)  # repeated rows count once
    table = table.take(pa.array(first))
    docs, own = table.column("doc").to_numpy(), table.column("own").to_numpy()
    cross = table.column("i")[0].as_py() != table.column("j")[0].as_py()
    made = [_unpacked(b) for b in table.column("set").to_pylist()]
    size = np.array([len(s) for s in made])
    token, inverse, count = np.unique(np.concatenate(made), return_inverse=True, return_counts=True)
    shared = count[inverse] > 1
    column = (np.cumsum(count > 1) - 1)[inverse[shared]]
    by = np.argsort(column, kind="stable")
    column, owner = column[by], np.repeat(np.arange(len(docs)), size)[shared][by]
    both = np.zeros((len(docs), len(docs)), np.float32)
    width = int((count > 1).sum())
    for at in range(0, width, 4096):  # a slice of the shared tokens at a time, as a 0-1 matrix
        a, b = np.searchsorted(column, [at, at + 4096])
        part = np.zeros((len(docs), min(4096, width - at)), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        both += part @ part.T
    either = size[:, None] + size[None, :] - both
    linked = both >= THRESHOLD * either - 1e-3
    np.fill_diagonal(linked, False)
    if cross:
        linked &= own[:, None] != own[None, :]
    links = linked.sum(axis=1)
    if not links.any():
        return None
    some = links > 0
    return {"doc": docs[some], "links": links[some].astype(np.int64), "root": docs[_roots(linked)][some]}


def exact_links(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """(doc, links, root) of the texts of ``groups`` (node, root) that are linked: how many other ones they are similar to,
    and the least text of all that links connect them with. Repeated ids must have equal texts."""
    sizes = groups.groupBy("root").agg(F.count("*").alias("members"))
    groups = cut(groups.join(sizes, "root").select(F.col("node").alias("doc"), F.col("root").alias("group"), "members"))
    wanted = docs.join(_listed(groups), "doc").select("group", "members", "doc", "text")

    @tidy
    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHasher()
        for batch in batches:
            for first, hashes, offsets in words(batch.column("text")):
                made, bounds = shingles(hashes, offsets, WIDTH)
                packed = [_packed(made[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(first, len(packed)) for c in ("group", "members", "doc")], pa.array(packed, pa.binary())], names=["group", "members", "doc", "set"])

    dealt = block_pairs(wanted.mapInArrow(sets, "group long, members long, doc long, set binary"), BLOCK)
    counted = cut(each_group(dealt.select("pair", "doc", "own", "i", "j", "set"), "pair", _exact_links, COUNTED))
    per_doc = counted.groupBy("doc").agg(F.sum("links").alias("links"))
    roots = components(counted.select(F.col("doc").alias("a"), F.col("root").alias("b")), counted.count())
    return per_doc.join(roots, per_doc.doc == roots.node, "left").select("doc", "links", F.coalesce("root", "doc").alias("root"))


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, class_id, n_links and group_id.

    class_id is the least id of the texts with the same set of shingles; n_links the number of other classes at a
    Jaccard similarity of THRESHOLD or more; group_id the least id of all that links and classes connect. Rows
    with no words, or a null text, have no class and no group but their own; null ids stay null. Repeated rows are
    equal texts. An empty table gives an empty result.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    marked = stored(signatures(docs, "doc", "text"))
    classes = cut(marked.where("size > 0 and doc is not null").groupBy("set_key").agg(F.min("doc").alias("class_id"), F.first("values").alias("values"), F.first("sketch").alias("sketch")))
    sets = classes.select(F.col("class_id").alias("doc"), "values", "sketch")
    loose = loose_links(sets)
    groups = components(loose, loose.count())
    linked = exact_links(docs, groups)
    linked = linked.withColumnRenamed("doc", "class_id")
    with_class = marked.select("doc", "size", "set_key").join(classes.select("set_key", "class_id"), "set_key", "left")
    found = with_class.join(linked, "class_id", "left")
    own = F.coalesce("class_id", "doc")
    return found.select(
        F.col("doc").alias("doc_id"),
        F.col("size").alias("n_shingles"),
        own.alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", own).alias("group_id"),
    )
