import hashlib
import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from infield.llm import chat_windows, decontaminate, html_text, licenses, neighbours, url_filter

# URL filter ---------------------------------------------------------------------------------------------

RULES = [url_filter.parse_rule(*r) for r in (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_for(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_url_rules_and_parts(spark):
    rng = random.Random(1)
    urls = [None, "", "no scheme", "http://", "http://a.org", "HTTP://A.Example.ORG/es/1", "x://b.example.org?/es/", "ftp://example.org/en/12#x", "http://ÄB.com/fr/", "http://com/de/x", "http://xcom/de/", "http://a.com/fr?q=://z.org/", "http://a.net/fr/\nx"]
    urls += [f"http://{rng.choice(['a', 'spam-farm', 'news'])}.{rng.choice(['example.org', 'example.com', 'example.net'])}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randint(1, 300)}" for _ in range(400)]
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    rows = {r.page_id: r for r in url_filter.judge(df, RULES).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        host, path = parts(u)
        rule, verdict = rule_for(host, path)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule), u
        assert rows[i].verdict == verdict if verdict else rows[i].verdict in ("allow", "block")


def test_url_model_learns_what_the_rules_say(spark):
    rng = random.Random(2)
    rules = [url_filter.parse_rule("allow", "good.org/"), url_filter.parse_rule("block", "bad.org/")]
    rows = [f"http://good.org/articles/history-of-{rng.choice(['rome', 'paris', 'art'])}-{i}" for i in range(300)] + [f"http://bad.org/xxx-casino-{rng.choice(['win', 'bet'])}-{i}" for i in range(300)]
    unseen = ["http://q.net/articles/history-of-rome-9"] * 2 + ["http://q.net/xxx-casino-bet-7"] * 2
    df = spark.createDataFrame([(i, u) for i, u in enumerate(rows + unseen)], "page_id long, url string")
    found = {r.page_id: r for r in url_filter.judge(df, rules).collect()}
    assert [found[600 + i].verdict for i in range(4)] == ["allow", "allow", "block", "block"]
    assert found[600].score == found[601].score


def test_url_filter_without_rows_or_classes(spark):
    df = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    assert url_filter.judge(df, RULES).first().verdict == "allow"
    assert url_filter.judge(df.limit(0), RULES).count() == 0
    with pytest.raises(ValueError):
        url_filter.judge(df, [("allow", f"h{i}", "/") for i in range(1001)])


# Chat windows -------------------------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_round_trip(spark):
    rng = random.Random(3)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "é", "漢", "🙂", "\n", "word ", "/INST]", "s>"]
    rows = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"), (5, 0, None, None), (5, None, "x</s>[INST]", "\\")]
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv + 10, turn, rng.choice(["system", "user", "assistant"]), "".join(rng.choice(bits) for _ in range(rng.choice([0, 3, 50, 900])))))
    rows += [rows[10]] * 2
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, window string")
    made = chat_windows.windows(df)
    found = {r.conv_id: r for r in chat_windows.read_back(made).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        row = found[conv]
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))
    windows = made.collect()
    assert {r.conv_id: sum(len(w.formatted) for w in windows if w.conv_id == r.conv_id) for r in found.values()} == {r.conv_id: r.formatted_chars for r in found.values()}


def test_windows_keep_system_turn_history_and_budget(spark):
    rows = [(1, 0, "system", "S" * 100)] + [(1, i, ["user", "assistant"][i % 2 == 0], f"{i}" * 300) for i in range(1, 20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = sorted(chat_windows.windows(df).collect(), key=lambda w: w.window)
    assert len(made) > 2
    for w in made[1:]:
        assert w.formatted.startswith("<s>system[INST]SSS") and w.repeated >= 2
        assert len(w.formatted) <= 120 + chat_windows.HISTORY + chat_windows.SPAN + 620
    assert sum(w.n_turns for w in made) == 20
    assert chat_windows.windows(df.limit(0)).count() == 0


def test_chat_formatting_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat_windows.read_back(chat_windows.windows(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Neighbours ---------------------------------------------------------------------------------------------

def exact(vectors, k):
    ids = sorted(vectors)
    m = np.array([vectors[i] for i in ids])
    out = {}
    for q in (i for i in ids if i % 20 == 0):
        score = m @ np.array(vectors[q])
        order = [i for _, i in sorted((-s, i) for s, i in zip(score.round(12), ids, strict=True) if i != q)][:k]
        out[q] = order
    return out


def found_by(df, k=20):
    out = {}
    for r in neighbours.nearest(df, df.where("vec_id % 20 = 0"), k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((8, 24))
    vectors = {i: (centres[i % 8] + 1.5 * rng.standard_normal(24)).astype(np.float32).astype(float).tolist() for i in range(3000)}
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors.items()], "vec_id long, embedding array<float>, rank int")
    found, truth = found_by(df), exact(vectors, 20)
    hits = sum(len({v for _, v, _ in found[q]} & set(truth[q])) for q in truth)
    assert hits >= 0.9 * 20 * len(truth)
    for q, rows in found.items():
        assert [r for r, _, _ in rows] == list(range(1, 21))
        for _, v, s in rows:
            assert s == pytest.approx(np.dot(vectors[q], vectors[v]), abs=1e-9)
        assert [(-s, v) for _, v, s in rows] == sorted((-s, v) for _, v, s in rows)


def test_odd_vectors_take_no_part_and_ties_go_to_smaller_ids(spark):
    same = [1.0, 0.0, 2.0]
    rows = [(i, same) for i in range(0, 60)] + [(60, None), (80, []), (100, [0.0, 0.0, 0.0]), (120, [float("nan"), 1.0, 1.0]), (140, [1.0, None, 1.0]), (160, [float("inf"), 1.0, 1.0]), (None, same), (180, [1.0, 1.0])]
    found = found_by(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert set(found) == {0, 20, 40}
    assert [v for _, v, _ in found[20]] == [*range(20)]
    assert [v for _, v, _ in found[0]] == [*range(1, 21)]
    few = found_by(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>"))
    assert [v for _, v, _ in few[0]] == [1, 2]
    assert found_by(spark.createDataFrame([], "vec_id long, embedding array<double>")) == {}


# Licenses -----------------------------------------------------------------------------------------------

def test_licenses(spark):
    lorem = "some words of a file that say nothing of interest at all\n" * 5
    files = [
        ("a/LICENSE", "Released under the MIT License."), ("a/x/one.py", lorem), ("a/x/two.py", lorem + "Licensed under CC BY-NC 4.0."), ("a/b/COPYING", "Licensed under the Apache License, Version 2.0."), ("a/b/c/d/deep.py", None),
        ("top.py", lorem), (None, ""), ("z/three.py", lorem + "SPDX-License-Identifier: GPL-3.0"), ("z/four.py", lorem + "This page tells how a license plate is made in a factory of the north"), ("a/x/one.py", lorem),
    ]
    df = spark.createDataFrame([(i, p, t, "own") for i, (p, t) in enumerate(files)], "n long, path string, text string, license string")
    rows = {r.n: (r.license, r.found, r.from_dir) for r in licenses.scan_licenses(df).collect()}
    assert rows[0][:2] == ("MIT", "header")
    assert rows[1] == rows[9] == ("MIT", "inherited", "a")
    assert rows[2] == ("CC-BY-NC-4.0", "header", None)
    assert rows[4] == ("Apache-2.0", "inherited", "a/b")
    assert rows[5] == rows[6] == (None, None, None)
    assert rows[7][0] == "GPL-3.0" and rows[8][0] is None
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def _plain_licenses(texts):
    """Licence and score of each text by dictionaries: every unit against every template."""
    import math
    import re

    words = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())
    terms = lambda ws: set(ws) | set(zip(ws, ws[1:], strict=False))
    templates = [(name, terms(words(t))) for name in sorted(licenses.TEMPLATES) for t in (f"SPDX-License-Identifier: {name}", *licenses.TEMPLATES[name])]
    known = set().union(*[t for _, t in templates])
    docs = [terms(words(t or "")) for t in texts]
    idf = {k: math.log((len(texts) + 1) / (1 + sum(k in d for d in docs))) + 0.5 for k in known}
    other = sum(idf.values()) / len(idf)
    norm = lambda t: math.sqrt(sum(idf[k] ** 2 for k in t))
    out = []
    for text in texts:
        text, best = text or "", None
        gap, stop, line = r"\n[ \t\r#*/;%-]*(?=\n)", r"(?<=[.!?])(?=\s)", r"[\n\r]"
        for cuts in (None, gap, f"{gap}|{stop}", line, f"{line}|{stop}"):
            for unit in re.split(cuts, text) if cuts else [text]:
                ws = words(unit)
                mine = terms(ws) & known
                if not mine:
                    continue
                length = math.sqrt(norm(mine) ** 2 + sum(w not in known for w in ws) * other**2)
                by_name = {}
                for name, t in templates:
                    cosine = norm(mine & t) ** 2 / (length * norm(t))
                    if cosine >= licenses.LEAST:
                        by_name[name] = max(by_name.get(name, (0, 0)), (round(cosine**2 * norm(t), 9), cosine))
                first, *others = sorted(by_name.items(), key=lambda kv: (-kv[1][0], kv[0])) or [None]
                if first and (not others or others[0][1][0] <= first[1][0] * (1 - licenses.MARGIN)) and (best is None or (-first[1][0], first[0]) < best[0]):
                    best = ((-first[1][0], first[0]), round(min(first[1][1], 1.0), 9))
        out.append((best[0][1], best[1]) if best else (None, None))
    return out


def test_licenses_equal_plain_search_and_tell_versions(spark):
    full = {name: max(texts, key=len) for name, texts in licenses.TEMPLATES.items()}
    texts = ["Copyright (c) 2020 Jo Doe\n\n" + full["MIT"], "Copyright 2021, some company\n" + full["BSD-3-Clause"], full["BSD-2-Clause"], full["ISC"]]
    named = ["MIT", "BSD-3-Clause", "BSD-2-Clause", "ISC"]
    texts.append("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n\n                            Preamble\n\n  The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n")
    texts += [full["GPL-2.0"], "int main() { return 0; }\n// " + full["Apache-2.0"] + "\nint other;", "This work is licensed under the GNU General Public License, version 1.", "SPDX-License-Identifier: WTFPL"]
    named += ["GPL-3.0", "GPL-2.0", "Apache-2.0", None, None]
    texts += ["", None, "x", "\n\n\n", "word " * 30_000 + "\nReleased under the MIT License.\n" + "more " * 30_000, "the use of the software " * 2_000]
    named += [None, None, None, None, "MIT", None]
    texts += ["plain words of some file about nothing, number %d" % i for i in range(40)]
    df = spark.createDataFrame([(i, f"d{i}/file", t) for i, t in enumerate(texts)], "n long, path string, text string").repartition(3)
    rows = {r.n: r for r in licenses.scan_licenses(df).collect()}
    for i, (name, score) in enumerate(_plain_licenses(texts)):
        own = rows[i].found == "header"
        assert (rows[i].license if own else None) == name, i
        assert not own or abs(rows[i].score - score) < 1e-6
        assert i >= len(named) or name == named[i], i


def test_licenses_are_inherited_as_by_a_walk(spark):
    import os

    paths = [f"{a}/{b}/{c}" for a in ("p", "q", "r") for b in ("x", "x/y", "z/w/v") for c in ("one.py", "LICENSE", "two.py")] + ["LICENSE", "p/LICENSE", "alone.py"]
    own = {p: name for p, name in zip([p for p in paths if p.endswith("LICENSE")], ["MIT", None, "ISC", None, "BSD-2-Clause", None, None, "Unlicense", None, None, "CC-BY-4.0"], strict=True)}
    rows = spark.createDataFrame([(p, licenses.TEMPLATES[own[p]][0] if own.get(p) else "nothing to say") for p in paths], "path string, text string")
    speaks = {os.path.dirname(p): name for p, name in own.items() if name}
    for r in licenses.scan_licenses(rows).collect():
        at = os.path.dirname(r.path)
        while at and at not in speaks:
            at = os.path.dirname(at)
        assert r.license == (own.get(r.path) or speaks.get(at)), r


# Decontamination ----------------------------------------------------------------------------------------

def words(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "in"]) if rng.random() < 0.4 else "".join(rng.choice("aeiou") + rng.choice("nrstlmd") for _ in range(3)) for _ in range(n))


def test_leaks_equal_brute_force_on_copies_and_find_paraphrases(spark):
    rng = random.Random(4)
    items = [(i, words(rng, rng.choice([12, 30, 55])) + ". " + words(rng, 6) + ".") for i in range(30)] + [(98, None), (99, "")]
    docs, planted = [], set()
    for d in range(300):
        text = words(rng, rng.choice([5, 100, 400]))
        if d % 5 == 0:
            i = rng.randrange(30)
            text = text + "\n" + items[i][1].upper() + " " + words(rng, 50)
            planted.add((d, i))
        docs.append((d, text, "x"))
    for d in range(300, 330):
        item = items[d - 300][1].split()
        docs.append((d, words(rng, 60) + " " + " ".join(w for n, w in enumerate(item) if n % 6 != 2) + " " + words(rng, 60), "x"))
    docs += [(400, None, "x"), (401, "", "x"), (402, docs[0][1], "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, bench).collect()}
    copies = {(d, i) for d, t, _ in docs for i, b in items if b and t and b.lower() in t.lower()}
    assert planted <= copies <= found
    reworded = {(300 + i, i) for i in range(30)}
    assert len(reworded & found) >= 28 and not found - copies - reworded
    kept = decontaminate.clean(df, bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _, _ in docs} - {d for d, _ in found}
    assert kept.columns == df.columns


def test_leaks_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.leaks(docs.limit(0), items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == 1


def test_common_subsequence():
    rng = random.Random(5)
    for _ in range(50):
        a, b = [rng.randrange(6) for _ in range(rng.randrange(1, 20))], [rng.randrange(6) for _ in range(rng.randrange(0, 20))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(a, b) == table[-1][-1]


# HTML ---------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site"><a href=/>Home</a></header><nav><ul><li><a href="/a">one</a></li><li><a>two</a></li></ul></nav><div class="cookie-notice">We use cookies &amp; more</div>
<!-- ad <p>x</p> --><div class="ad">buy now</div><article><h1>Head &amp; line</h1><p><b>First   sentence&nbsp;here.<br><p>Second one
of <i>two</i> lines.</p><div class="advert">not this</div><ul><li>a point</li></ul><form><input name=q><button>Go</button></form></article>
<section id="comments"><article class="comment"><p>I think so too, this is a long remark by a reader.</p></article></section><aside>side words</aside><footer>&copy; all</footer></body></html>"""


def test_html_blocks():
    text = html_text.extract(PAGE, html_text.weights({}))
    assert text.split("\n\n") == ["Head & line", "First sentence here.", "Second one of two lines.", "a point"]


def test_html_weights_come_from_labelled_pages(spark):
    pages = [(1, PAGE), (2, "<html><body><article><p>words here</p></article><nav><li>x y</li></nav></body></html>")] * 25
    weight = html_text.learn(spark.createDataFrame(pages, "page_id long, html string"))
    assert weight["word"] >= html_text.LEAST_WORD and weight["<nav>"] < weight["<p>"] <= -html_text.LEAST_TAG
    assert html_text.learn(spark.createDataFrame([], "page_id long, html string"))["word"] > 0


def test_html_odd_pages(spark):
    odd = [None, "", "<p></p>", "no markup at all", "<", "a < b > c", "<p>unclosed <b>bold", "<!-- never closed <p>x</p>", "<script>var x = 1", "<p>" * 3000 + "deep", "<div class='ad' <p>x", "<p>&lt;b&gt; &amp &#65;</p>", "<p>" + "word " * 200_000 + "</p>"]
    df = spark.createDataFrame([(i, h, "old") for i, h in enumerate(odd)], "page_id long, html string, text string")
    rows = {r.page_id: (r.text, r.n_chars) for r in html_text.main_text(df, html_text.weights({})).collect()}
    assert all(n == len(t) for t, n in rows.values())
    assert [rows[i][0] for i in (0, 1, 2, 7, 8)] == [""] * 5
    assert rows[3][0] == "no markup at all" and rows[6][0] == "unclosed bold" and rows[11][0] == html.unescape("&lt;b&gt; &amp &#65;")
    assert rows[9][0] == "deep" and rows[12][1] == 999_999


def test_huge_vectors_and_repeated_ids(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(2).tolist()) for i in range(0, 300)]
    rows += [(400, [1e200, 1e200]), (401, [1e-200, -1e-200]), (402, [1e308, 1e308]), (20, rows[20][1]), (20, rows[20][1]), (39, [50.0, 0.1]), (39, [0.1, 60.0])]
    found = found_by(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5)
    many = {}
    for i, v in rows:
        many.setdefault(i, []).append(np.array(v))
    for q in (20, 40, 400):
        with np.errstate(over="ignore", invalid="ignore"):
            score = {i: max(float(a @ b) for a in many[q] for b in vs) for i, vs in many.items() if i != q}
        best = sorted(score, key=lambda i: (-score[i] if score[i] == score[i] else np.inf, i))[:5]
        assert [v for _, v, _ in found[q]] == best, q


def test_few_vectors_are_verified():
    """Clustered vectors: most of a block is never looked at, and the nearest are found."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((200, 32))
    data = centres[np.arange(8000) % 200] + 0.3 * rng.standard_normal((8000, 32))
    ids = np.arange(8000)
    found = neighbours.Block(data, ids).search(data[:60], ids[:60], 10)
    truth = {q: set(np.argsort(-np.where(ids == q, -np.inf, data @ data[q]), kind="stable")[:10].tolist()) for q in range(60)}
    hits = sum(len(truth[q] & set(found["vec_id"][found["query_id"] == q].tolist())) for q in range(60))
    assert hits >= 0.9 * 600 and found["verified"].mean() <= 0.05 * 8000


def test_url_scores_equal_models_of_all_urls(spark, monkeypatch):
    """The method's own verdicts against two whole models fitted in one process; and very long, empty and null URLs."""
    from infield.llm import char_lm, gram_join
    from infield.llm.common import codepoints

    monkeypatch.setattr(gram_join, "GRAMS", 300)
    rng = random.Random(8)
    urls = [f"https://{rng.choice(['good', 'bad'])}.org/{rng.choice('abc')}{rng.randint(1, 999)}?q={rng.randint(1, 9)}#{rng.choice('xyz')}" for _ in range(500)]
    urls += ["https://other.net/a1?q=1", "https://other.net/" + "ab/" * 20_000, "", None, "no scheme", "https://élan.net/漢"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rules = [url_filter.parse_rule("allow", "good.org/"), url_filter.parse_rule("block", "bad.org/")]
    rows = sorted(url_filter.judge(df, rules).collect(), key=lambda r: r.page_id)
    teaches = {r.url for r in df.where(F.pmod(F.xxhash64("url", F.lit(3)), F.lit(2)) == 0).collect()}
    table, models = url_filter.url_table(), []
    made = lambda u: char_lm.grams(char_lm.symbols(codepoints(u or ""), table), url_filter.ORDER)
    for host in ("good", "bad"):
        c = char_lm.Counter()
        for u in urls:
            if u and f"//{host}.org" in u and u in teaches:
                c.add(made(u))
        models.append(char_lm.fit(*c.compact(), url_filter.ORDER))
    for r in rows:
        g = made(r.url)
        want = float(models[0].score(g).astype(float).sum() - models[1].score(g).astype(float).sum()) / len(g) if len(g) else 0.0
        assert r.score == pytest.approx(want, abs=1e-3)
        assert r.rule or r.verdict == ("allow" if r.score >= r.threshold else "block")


def test_regions_are_the_best_there_are():
    rng = random.Random(9)
    for _ in range(300):
        scores = [rng.randint(-4, 4) for _ in range(rng.randint(0, 30))]
        made = html_text.regions(scores)
        sums = [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        assert max((r[2] for r in made), default=0) == max([0, *sums])
        assert all(sum(scores[a:b]) == s for a, b, s in made) and all(x[1] <= y[0] for x, y in zip(made, made[1:], strict=False))
    assert len(html_text.regions([1, -4] * 100_000)) == 100_000


WORDS = "The committee met on Tuesday and agreed that the harbour should be dredged before the winter storms arrive. "
LONG = [f"{WORDS * 3}Part {i}." for i in range(6)]
BODY = "".join(f"<p>{x}</p>" for x in LONG)
SIDE = "Trending now: ten things to buy this week " * 25
LINKS = "".join(f"<li><a href='/{i}'>Go to page {i}</a></li>" for i in range(40))


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div>{''.join(f'<p>{x}</p>' for x in LONG[:3])}</div><div class='sidebar'>{SIDE}</div><div>{''.join(f'<p>{x}</p>' for x in LONG[3:])}</div></body>",
        f"<article>{''.join(f'<p>{x}</p>' for x in LONG[:4])}<section id='related-work'><p>{LONG[4]}</p><p>{LONG[5]}</p></section></article>",
        f"<body><nav><ul>{LINKS}</ul></nav><main>{BODY}</main><aside>{SIDE}</aside></body>",
        f"<body><table><tr><td><ul>{LINKS}</ul></td><td>{BODY}</td></tr></table><div id='footer'>{SIDE}</div></body>",
        f"<body><div class='cookie-notice'>We use cookies. <button>OK</button></div><div id='content'>{BODY}</div><div id='comments'><p>{SIDE}</p><p>{SIDE}</p></div></body>",
        f"<body><header><h2>Site</h2><ul>{LINKS}</ul></header><section>{BODY}</section><form><label>Mail</label><input><p>{SIDE}</p></form></body>",
        f"<body><div role='navigation'>{LINKS}</div><article><div class='share'><a href='#'>Share this</a></div>{BODY}<div class='related'><ul>{LINKS}</ul></div></article></body>",
        f"<body><article>{BODY}</article><section class='comments'><article><p>{SIDE}</p></article><article><p>{SIDE}</p></article></section></body>",
        f"<html><head><title>x</title></head><body><center><font>{'<br><br>'.join(LONG)}</font></center></body></html>",
        f"<body><div class='post'>{''.join(f'<p>{x}</p>' for x in LONG[:2])}<div class='ad'>{SIDE}</div>{''.join(f'<p>{x}</p>' for x in LONG[2:])}</div><div class='popup'>{SIDE}</div></body>",
        f"<body><article><div class='notice'>This article is old.</div>{BODY}<my-widget>x</my-widget></article></body>",
        f"<body><div class='banner-history'>{BODY}</div></body>",
    ],
)
def test_html_layouts_keep_all_of_the_article(page):
    text = html_text.extract(page, html_text.weights({}))
    assert all(x.strip() in text for x in LONG)
    for word in ("Trending", "Go to page", "cookies", "Share", "is old", "Site"):
        assert word not in text


def test_a_passage_of_a_long_benchmark_text_is_found(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    item = [word() for _ in range(200)]
    common = [word() for _ in range(300)]
    rest = lambda: [rng.choice(common) for _ in range(80)]
    docs = [(1, " ".join(rest() + item[70:130] + rest())), (2, " ".join(rest() + item[70:80] + rest())), (3, " ".join(rest())), (4, " ".join(item))]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")).collect()
    assert {r.doc_id for r in found} == {1, 4}
