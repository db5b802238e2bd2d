from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from infield.llm import char_lm, common, gram_join, language_id, quality
from infield.llm.common import codepoints

DATA = "/root/testdata/sf0.1"


def fitted(texts, order, table):
    c = char_lm.Counter()
    for t in texts:
        c.add(char_lm.grams(char_lm.symbols(codepoints(t), table), order))
    return char_lm.fit(*c.compact(), order)


def entropy(model, text, order, table):
    return -float(model.score(char_lm.grams(char_lm.symbols(codepoints(text), table), order)).astype(float).mean())


def random_texts(seed, n, length, letters="abcdefghijklmnopqrstuvwxyz"):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(letters), length)) for _ in range(n)]


@pytest.mark.parametrize("op", ["op3", "op9"])
def test_all_n_grams_count_however_many_there_are(spark, op, monkeypatch):
    """More different n-grams than the 250,000 (op3) and 2,000,000 (op9) that were once kept."""
    texts = random_texts(1, 100, 5_000 if op == "op3" else 25_000)
    odd = ["abcabcabc zq zq", texts[0][:300], "été 漢字 xyz"]
    if op == "op3":
        monkeypatch.setattr(language_id, "sampled", lambda text="text": F.lit(False))
        models = language_id.train(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(4))
        assert models.tables.size > 250_000
        found = language_id.predict(spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i long, text string"), models)
        order, table = language_id.ORDER, char_lm.letter_table()
        got = {r.i: r.cross_entropy for r in found.collect()}
    else:
        tables = quality.learn(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4))
        assert tables.size > 2_000_000
        order, table = quality.ORDER, char_lm.raw_table()
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "i long, text string")
        scores = gram_join.sums(docs, tables, char_lm.raw_table).collect()
        by_digest = {bytes(r.digest): -r.totals[0] / r.symbols for r in scores}
        got = {r.i: by_digest[bytes(r.d)] for r in docs.select("i", gram_join.digest().alias("d")).collect()}
    whole = fitted(texts, order, table)
    for i, t in enumerate(odd):
        assert abs(got[i] - entropy(whole, t, order, table)) < 1e-3


def test_sums_over_chunks_equal_a_lookup(spark, monkeypatch):
    for name, value in (("HELD", 2_000), ("PIECE", 50), ("GRAMS", 100)):  # many chunks, rows and shards
        monkeypatch.setattr(gram_join, name, value)
    texts = random_texts(2, 700, 60, "abcde ") + ["a" * 3_000, "", None, "ab cd " * 400] * 2
    train = [t for t in texts if t][::2]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    tables = quality.learn(spark.createDataFrame([(t,) for t in train], "text string"))
    rows = {bytes(r.digest): r for r in gram_join.sums(df, tables, char_lm.raw_table).collect()}
    model, table = fitted(train, quality.ORDER, char_lm.raw_table()), char_lm.raw_table()
    for r in df.select("text", gram_join.digest().alias("d")).collect():
        found = rows[bytes(r.d)]
        n = len(char_lm.grams(char_lm.symbols(codepoints(r.text or ""), table), quality.ORDER))
        assert found.symbols == n
        assert not n or abs(-found.totals[0] / n - entropy(model, r.text, quality.ORDER, table)) < 1e-4


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
@pytest.mark.parametrize("left_out", ["en", "de"])
def test_texts_of_a_language_that_was_not_learned_are_rejected(spark, left_out):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("length(text) >= 200")
    held = language_id.held_out()
    models = language_id.train(docs.where(~held & (F.col("lang") != left_out)).select("lang", "text"))
    rows = language_id.predict(docs.where(held), models).select("lang", "accepted").collect()
    foreign, known = ([r.accepted for r in rows if (r.lang == left_out) == f] for f in (True, False))
    print(left_out, len(foreign), sum(foreign), len(known), sum(known))
    assert len(foreign) > 10 and sum(foreign) <= 0.05 * len(foreign)
    assert sum(known) >= 0.98 * len(known)


def test_batches_for_python_are_bounded_by_bytes(spark):
    """Rows of 100 KB, as n-grams by shard are: 1,000 of them made one batch, held by the executor and by its worker."""
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    common.short_batches(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "size": [b.nbytes]})

    rows = spark.range(0, 400, 1, 1).selectExpr("repeat(cast(id % 10 as string), 100000) as data")
    found = rows.mapInArrow(sizes, "rows long, size long").collect()
    assert sum(r["rows"] for r in found) == 400
    assert max(r["size"] for r in found) <= common.BATCH_BYTES + 200_000
    short = spark.range(0, 5_000, 1, 1).mapInArrow(sizes, "rows long, size long").collect()
    assert {r["rows"] for r in short} == {common.BATCH_ROWS}


def test_counts_of_many_models_are_held_within_one_bound(spark, monkeypatch):
    monkeypatch.setattr(char_lm, "MOST", 2_000)
    texts = random_texts(3, 300, 200)
    rows = [(f"m{i % 40}", t) for i, t in enumerate(texts)]
    plain = Counter()
    for model, t in rows:
        plain.update((model, int(g)) for g in char_lm.grams(char_lm.symbols(codepoints(t), char_lm.letter_table()), 4))
    monkeypatch.setattr(common, "BATCH_ROWS", 10)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    counted = char_lm.count_grams(spark.createDataFrame(rows, "model string, text string").coalesce(1), "model", "text", 4, char_lm.letter_table)
    got = {(r.model, r.gram): r.n for r in counted.collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == dict(plain)
