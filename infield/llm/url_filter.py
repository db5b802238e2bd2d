"""URL filter: rules first, then a ratio of character language models.

URLs that a rule decides teach two variable-order Markov models over the whole URL, one of accepted and one of rejected
URLs: exact counts of contexts up to four characters, smoothed by interpolating the shorter ones (Kneser-Ney). Counts
grow with the URLs; URLs meet them by shard (``gram_join``). Other URLs are judged by the difference of the two log
likelihoods a character, against a threshold that is calibrated on rule-decided URLs the models weren't trained on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from infield.llm import gram_join
from infield.llm.char_lm import count_grams
from infield.llm.common import MAX_BROADCAST_KEYS

ORDER = 5  #: characters of the longest n-gram
MOST_RULES = 1_000
BINS, RANGE = 400, 4.0  #: of the histogram for calibration, in nats a character each way

Rule = tuple[str, str, str]  #: verdict, host, path


def parse_rule(verdict: str, text: str) -> Rule:
    """A rule such as ``org/`` or ``example.org/en/1``: the host goes up to the first slash, the path from there."""
    host, slash, path = text.partition("/")
    return verdict, host, slash + path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII letters in lower case) and path of a URL; both '' if it is null or has no ``://``."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1)
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"\A[^/?#]*(/[^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls. A rule fits its host and all its subdomains."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def url_table() -> np.ndarray:
    """Symbol of each code point of a URL: itself, folded to 12 bits."""
    cp = np.arange(0x110000)
    return np.where(cp < 4096, cp, 4095 - cp % 2048).astype(np.uint16)


def threshold(held: DataFrame) -> float:
    """The score that parts accepted from rejected URLs (score, verdict) best: the largest sum of both rates, 0 without both."""
    b = F.least(F.greatest(F.floor((F.col("score") + RANGE) * (BINS / (2 * RANGE))), F.lit(0)), F.lit(BINS - 1)).cast("int")
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for r in held.groupBy(b.alias("bin"), "verdict").count().collect():
        (good if r.verdict == "allow" else bad)[r.bin] += r["count"]
    if not good.sum() or not bad.sum():
        return 0.0
    below = np.concatenate([[0], np.cumsum(bad)]) / bad.sum() - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    best = np.flatnonzero(below == below.max())
    return float(best[len(best) // 2] * (2 * RANGE / BINS) - RANGE)


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict ('allow' or 'block'), score and threshold.

    Models and threshold come from the rows that a rule decides, half each by a hash of the URL, repeated rows
    counting each time. Where no rule decides, the verdict is allow from the threshold on; if rules accept nothing
    or reject nothing, there is nothing to tell them apart by, and it is allow. A null or malformed URL has an empty
    host and path, a null or empty one the score 0. Input columns with these names are replaced.
    """
    names = ("host", "path", "rule", "verdict", "score", "threshold")
    rows = pages.drop(*[n for n in names if n != url])
    host, path = url_parts(F.col(url))
    text, verdict = rule_of(F.col("_host"), F.col("_path"), rules)
    ruled = rows.withColumn("_url", F.col(url)).withColumns({"_host": host, "_path": path}).withColumns({"_rule": text, "_verdict": verdict})
    taught = ruled.where(F.col("_verdict").isNotNull()).select("_url", F.col("_verdict").alias("verdict"), (F.pmod(F.xxhash64("_url", F.lit(3)), F.lit(2)) == 0).alias("teaches"))
    tables = gram_join.learn(count_grams(taught.where("teaches"), "verdict", "_url", ORDER, url_table), ORDER)
    score, limit = F.lit(0.0), -RANGE
    if tables.names == ["allow", "block"]:
        found = gram_join.sums(ruled, tables, url_table, "_url")
        scores = found.select(F.col("digest").alias("_digest"), F.when(F.col("symbols") > 0, (F.col("totals")[0] - F.col("totals")[1]) / F.col("symbols")).otherwise(0.0).alias("_score"))
        limit = threshold(taught.where("not teaches").select("verdict", gram_join.digest("_url").alias("_digest")).join(scores, "_digest").withColumnRenamed("_score", "score"))
        few = scores.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
        ruled = ruled.withColumn("_digest", gram_join.digest("_url")).join(F.broadcast(scores) if few else scores, "_digest", "left")
        score = F.col("_score")
    own = F.when(score >= limit, "allow").otherwise("block")
    rest = [F.col(c) for c in rows.columns if c not in names]
    return ruled.select(*rest, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.coalesce("_verdict", own).alias("verdict"), score.alias("score"), F.lit(limit).alias("threshold"))
