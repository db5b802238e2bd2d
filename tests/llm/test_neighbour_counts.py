"""Collision counting by packed signs: how much is verified, and how vectors are prepared."""

import numpy as np

from infield.llm import neighbours


def test_directions_without_clusters_are_found_with_few_products():
    """The hardest case: 6 % of a block's random directions are enough, where windows of projections took 8.5 %."""
    rng = np.random.default_rng(3)
    data = rng.standard_normal((16_384, 64))
    data /= np.linalg.norm(data, axis=1)[:, None]
    ids = np.arange(len(data))
    block = neighbours.Block(data, ids)
    assert block.bits.nbytes == len(data) * neighbours.PROJECTIONS // 8
    asked = ids[::128]
    found = block.search(data[asked], asked, 20)
    hits = 0
    for q in asked:
        products = np.where(ids == q, -np.inf, data @ data[q])
        hits += len(set(np.argsort(-products, kind="stable")[:20].tolist()) & set(found["vec_id"][found["query_id"] == q].tolist()))
    assert hits >= 0.9 * 20 * len(asked)
    assert found["verified"].mean() <= 0.065 * len(data)


def test_products_that_underflow_or_overflow_keep_their_order():
    """Scores of tiny and huge vectors tie or are no numbers; all that was verified is ordered by them."""
    for size in (1e-200, 1e200):
        data = size * np.random.default_rng(4).uniform(1.0, 1.9, (300, 8))
        found = neighbours.Block(data, np.arange(300)).search(data[:1], np.arange(1), 5)
        assert set(found["score"].tolist()) == {0.0 if size < 1 else np.inf}
        assert found["vec_id"].tolist() == sorted(found["vec_id"].tolist()) and found["verified"][0] >= 20


def test_classes_of_usable_vectors(spark):
    rows = [(1, [3.0, 4.0]), (2, [1e300, 1e300]), (3, [1e-320]), (4, [0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, []), (8, None), (None, [1.0]), (9, [-0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    assert {(r.vec_id, r.dim, r["class"]) for r in neighbours.usable(df).collect()} == {(1, 2, 2), (2, 2, 997), (3, 1, -1064), (9, 1, -1)}
