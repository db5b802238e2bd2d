import random
import re

import numpy as np
import pytest

from infield.llm import jaccard_join
from infield.llm.components import components

WORDS = [f"w{i}" for i in range(4000)]


def shingles(text):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_force(rows):
    """class, links and group of each id, by all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    classes = {}
    for i in sorted(sets):
        if sets[i]:
            classes.setdefault(sets[i], i)
    reps = sorted(classes.values())
    links = {i: set() for i in reps}
    for n, i in enumerate(reps):
        for j in reps[:n]:
            a, b = sets[i], sets[j]
            if len(a & b) >= 0.8 * len(a | b):
                links[i].add(j)
                links[j].add(i)
    root = {}
    for i in reps:
        if i not in root:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in root:
                    root[x] = i
                    todo += links[x]
    out = {}
    for i, s in sets.items():
        c = classes.get(s, i) if s else i
        out[i] = (c, len(links.get(c, ())), root.get(c, c))
    return out


def varied(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for base in range(12):
        words = [rng.choice(WORDS) for _ in range(rng.choice([60, 120, 400]))]
        for k in range(rng.choice([1, 3, 40])):
            rows.append(varied(rng, words, rng.choice([0, 0, 1, 2, 3, 6])))
    rows += ["", None, "a b", "a b", "A, b!", "x", "   ", "one two three four five"]
    rows += [rows[0]] * 30
    rng.shuffle(rows)
    data = list(enumerate(rows))
    df = spark.createDataFrame([(i, t, "s", i) for i, t in data], "doc_id long, text string, size string, node long")
    found = {r.doc_id: (r.class_id, r.n_links, r.group_id) for r in jaccard_join.similar(df).collect()}
    assert found == brute_force(data)


def test_large_groups_of_near_copies(spark):
    rng = random.Random(3)
    words = [rng.choice(WORDS) for _ in range(150)]
    data = [(i, varied(rng, words, rng.choice([0, 1, 1, 2]))) for i in range(700)] + [(1000 + i, " ".join(rng.choice(WORDS) for _ in range(80))) for i in range(50)]
    found = {r.doc_id: (r.class_id, r.n_links, r.group_id) for r in jaccard_join.similar(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert found == brute_force(data)


def test_empty_table(spark):
    assert jaccard_join.similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 7), (200, 201), (201, 200), (300, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in [*range(61), 100])
    assert found[200] == found[201] == 200


def test_each_row_of_a_large_node_meets_its_pivot_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART", 7)
    values = lambda doc: [0] * (64 - doc % 60) + [doc] * (doc % 60)
    rows = [(1, 50, doc, values(doc)) for doc in range(50)] + [(2, 3, doc, values(doc)) for doc in range(90, 93)]
    want = sorted((n, d, 0 if n == 1 else 90, sum(a == b for a, b in zip(v, values(0 if n == 1 else 90), strict=True)) / 64) for n, _, d, v in rows)
    for size in (3, 10_000):  # a part may come in several batches
        monkeypatch.setattr(jaccard_join, "PART", 7 if size > 3 else 1000)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            found = jaccard_join.beside_pivots(spark.createDataFrame(rows, "node long, size long, doc long, values array<int>").repartition(5)).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted((r.node, r.doc, r.pivot, r.share) for r in found) == want


def test_a_common_line_is_compared_at_once_and_nothing_is_lost_in_the_tree(spark, monkeypatch):
    rng = random.Random(4)
    line = [rng.choice(WORDS) for _ in range(30)]
    data = []
    for base in range(150):  # 600 texts share a line; four of each are near copies
        words = line + [rng.choice(WORDS) for _ in range(50)]
        data += [(base * 4 + k, varied(rng, words, k % 2)) for k in range(4)]
    df, met, whole = spark.createDataFrame(data, "doc_id long, text string"), [], jaccard_join.beside_pivots
    monkeypatch.setattr(jaccard_join, "beside_pivots", lambda large: met.append(large.count()) or whole(large))
    found = lambda: {r.doc_id: (r.class_id, r.n_links, r.group_id) for r in jaccard_join.similar(df).collect()}
    want = brute_force(data)
    assert found() == want and not met
    monkeypatch.setattr(jaccard_join, "SMALL", 32)  # the same texts by the tree
    assert found() == want and met


def test_agreeing_places():
    rng = np.random.default_rng(1)
    sketch = rng.integers(0, 2, (50, jaccard_join.VALUES)).astype(np.uint8)
    sketch[7] = sketch[3]
    assert (jaccard_join._agreeing(sketch, sketch[3]) == (sketch == sketch[3]).sum(axis=1)).all()
