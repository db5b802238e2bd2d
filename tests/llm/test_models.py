import random

import numpy as np
import pytest

from infield.llm import char_lm, language_id, quality
from infield.llm.common import codepoints

SYLLABLES = {"en": ["th", "er", "on", "an", "the", "ing"], "de": ["ein", "sch", "ung", "über", "ß", "keit"], "fr": ["eau", "ou", "é", "ç", "ment", "que"]}


def text_of(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words)).capitalize() + "."


def counted(texts, order, table):
    c = char_lm.Counter()
    for t in texts:
        c.add(char_lm.grams(char_lm.symbols(codepoints(t), table), order))
    return c.compact()


def test_probabilities_sum_to_one():
    rng = random.Random(1)
    table = char_lm.letter_table()
    texts = [text_of(rng, "en", 40) for _ in range(20)]
    model = char_lm.fit(*counted(texts, 3, table), 3)
    symbols = model.grams[0]
    for context in model.contexts[2][:20]:
        seen = np.array([(int(context) << 12) | int(s) for s in symbols])
        assert abs(np.exp(model.score(np.sort(seen)).astype(float)).sum() - 1) < 0.02  # the rest is for unseen symbols


def test_counter_adds_up():
    c = char_lm.Counter(held=10)
    values = np.random.default_rng(0).integers(0, 30, 1000)
    for part in np.array_split(values, 17):
        c.add(part)
    keys, n = c.compact()
    assert dict(zip(keys.tolist(), n.tolist(), strict=True)) == dict(zip(*(x.tolist() for x in np.unique(values, return_counts=True)), strict=True))


def test_language_of_held_out_texts(spark):
    rng = random.Random(3)
    rows = [(i, text_of(rng, lang, rng.choice([5, 60])), lang, "x") for i, lang in enumerate(list(SYLLABLES) * 120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = language_id.identify(df).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in found if r.held_out]
    assert len(held) > 50
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found) and all(r.accepted for r in held)


def test_texts_without_letters_and_strange_ones(spark):
    rng = random.Random(4)
    train = spark.createDataFrame([(text_of(rng, lang, 200), lang) for lang in SYLLABLES for _ in range(5)] + [(None, "en"), ("abc", None)], "text string, lang string")
    models = language_id.train(train)
    assert models.languages == ["de", "en", "fr"]
    texts = [None, "", "123 !!", "the on anther ing", "漢字漢字漢字漢字漢字漢字漢字漢字漢字漢字", "x" * 300_000]
    rows = language_id.predict(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), models).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows[:4]] == ["und", "und", "und", "en"]
    assert rows[0].score == 0 and not rows[0].accepted
    assert not rows[4].accepted and rows[4].lang_pred in models.languages


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language_id.identify(df).first().lang_pred == "und"
    assert language_id.identify(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        lang = list(SYLLABLES)[i % 3]
        text, good = text_of(rng, lang, rng.choice([20, 100, 300])), 1
        if i % 10 == 0:
            text, good = (text.upper().replace(" ", "!! ") if i % 20 else text.replace(" ", "*** ")), 0
        rows.append((i, text, lang, 1.5))
        if i % 7 < 4:
            labels.append((i, good))
    rows += [(1000, None, "en", 0.0), (1001, "", "de", 0.0), (1002, text_of(rng, "fr", 80), None, 0.0), (1003, "Then.", "xx", 0.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, keep double"), spark.createDataFrame(labels, "doc_id long, quality int"), labels


def test_quality_keeps_clean_and_rejects_junk(corpus):
    docs, labels, _ = corpus
    found = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    good = [found[i].keep for i in range(600) if i % 10]
    junk = [found[i].keep for i in range(600) if i % 10 == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.05 * len(junk)
    assert not found[1000].keep and not found[1001].keep and found[1002].keep
    kept = quality.classify(docs, labels, only_kept=True).select("doc_id").collect()
    assert {r.doc_id for r in kept} == {i for i, r in found.items() if r.keep}


def test_quality_without_labels_or_documents(corpus):
    docs, labels, _ = corpus
    assert quality.classify(docs, labels.limit(0), only_kept=True).count() == 602
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_discounts_are_between_zero_and_their_count():
    for counts in ({1: 10, 2: 5, 3: 2, 4: 1}, {1: 1}, {}, {1: 3, 2: 30}):
        assert all(0 < d < i for i, d in enumerate(char_lm.discounts(counts), 1))


def test_quality_of_documents_with_columns_of_its_names(spark):
    rows = [(i, f"plain words of an ordinary text number {i} for the model", "en", 5.0, "mine", "d") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, total double, symbols string, digest string")
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    for kept in (False, True):
        out = quality.classify(docs, labels, only_kept=kept).collect()
        assert len(out) >= 50 and {(r.total, r.digest) for r in out} == {(5.0, "d")}
