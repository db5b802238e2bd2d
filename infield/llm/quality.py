"""Quality classifier: perplexity under an interpolated modified Kneser-Ney character 5-gram model of trusted text.

Counts of trusted text are gathered in Spark, and all n-grams stay; texts are scored by a join of their n-grams with
these counts, dealt by shard (``gram_join``). One in SHARE of the trusted texts, by hash, doesn't teach the model:
thresholds are quantiles of those texts' scores by language, which the model judges as it judges any other text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from infield.llm import gram_join
from infield.llm.char_lm import count_grams, raw_table
from infield.llm.common import MAX_BROADCAST_KEYS, cut, semi_join

ORDER = 5
PRIOR = 60  #: symbols at the trusted mean that every text is filled up with, so that short texts aren't judged by chance
SHARE, ENOUGH = 5, 200  #: a language with fewer held-out texts has the limits of all languages together
QUANTILES = (0.001, 0.995)  #: of held-out trusted texts, by language; texts outside are rejected...
MARGIN = 0.08  #: ... if they are so many nats a symbol beyond
ANY = ""  #: the language of documents without one


def held_out(text: str = "text") -> Column:
    """Whether a trusted text sets the limits rather than teaching: equal texts stay together."""
    return F.pmod(F.xxhash64(text, F.lit(11)), F.lit(SHARE)) == 0


def learn(trusted: DataFrame, text: str = "text") -> gram_join.Tables:
    """The count tables of all of ``trusted``."""
    return gram_join.learn(count_grams(trusted.select(F.lit(ANY).alias("model"), text), "model", text, ORDER, raw_table), ORDER)


def _of_language(values: dict[str, float], lang: Column) -> Column:
    """The value of a language, or that of ANY."""
    found = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(found[lang], F.lit(float(values[ANY])))


def _filled(mean: dict[str, float], lang: Column, within: str = "") -> Column:
    """cross_entropy of a text filled up by PRIOR symbols at its language's mean; null for an empty one."""
    total, symbols = F.col(f"{within}total"), F.col(f"{within}symbols")
    return F.when(symbols > 0, (PRIOR * _of_language(mean, lang) - total) / (symbols + PRIOR))


def calibrate(scored: DataFrame, taught: DataFrame) -> tuple[dict[str, float], dict[str, tuple[float, float]]]:
    """The mean and the limits by language (ANY: over all) from texts (lang, total, symbols) that don't teach the model, and those that do."""
    scored = cut(scored.where("symbols > 0").select(F.coalesce("lang", F.lit(ANY)).alias("lang"), "total", "symbols"))
    both = scored.withColumn("lang", F.lit(ANY)).unionByName(scored.where(F.col("lang") != ANY))
    rows = both.groupBy("lang").agg((-F.sum("total") / F.sum("symbols")).alias("mean"), F.count("*").alias("n")).where((F.col("n") >= ENOUGH) | (F.col("lang") == ANY))
    mean = {r.lang: r["mean"] for r in rows.collect()}
    mean.setdefault(ANY, 0.0)
    rows = both.where(F.col("lang").isin(list(mean))).groupBy("lang").agg(F.percentile_approx(_filled(mean, F.col("lang")), list(QUANTILES), 10000).alias("q")).collect()
    limits = {r.lang: (r.q[0] - MARGIN, r.q[1] + MARGIN) for r in rows}
    limits.setdefault(ANY, (-np.inf, np.inf))
    # Texts that teach are known by heart, and so are their copies: the lower limit lets them pass.
    both = taught.withColumn("lang", F.lit(ANY)).unionByName(taught.where(F.coalesce("lang", F.lit(ANY)) != ANY)).where(F.col("lang").isin(list(mean)) & (F.col("symbols") > 0))
    for r in both.groupBy("lang").agg(F.percentile_approx(_filled(mean, F.col("lang")), QUANTILES[0], 10000).alias("q")).collect():
        low, high = limits[r.lang]
        limits[r.lang] = min(low, r.q - MARGIN), high
    return mean, limits


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The text and lang of documents that a label calls good."""
    return semi_join(docs.select("doc_id", "lang", "text"), labels.where("quality = 1"), "doc_id").select("lang", "text")


def classify(docs: DataFrame, labels: DataFrame, only_kept: bool = False) -> DataFrame:
    """``docs`` with cross_entropy, symbols and keep.

    ``labels`` (doc_id, quality) tell which documents are trusted; with none, every non-empty text is kept. Null and
    empty texts are rejected. Equal texts of one language get equal answers; ties at a limit are kept. Columns of ``docs``
    called like the three are replaced, others stay; names that begin with _quality_ are the operator's own.
    """
    trusted = trusted_rows(docs, labels)
    tables = learn(trusted.where(~held_out()))
    if not tables.names:  # no text teaches: too few are trusted to hold any out, or none are
        tables = learn(trusted)
    if not tables.names:
        kept = docs.withColumns({"cross_entropy": F.lit(None).cast("double"), "symbols": F.length("text").cast("long"), "keep": F.coalesce(F.length(F.trim("text")) > 0, F.lit(False))})
        return kept.where("keep") if only_kept else kept
    scores = gram_join.sums(docs, tables, raw_table).select(F.col("digest").alias("_quality_digest"), F.struct("symbols", F.col("totals")[0].alias("total")).alias("_quality_score"))
    known = cut(trusted.select("lang", held_out().alias("held"), gram_join.digest().alias("_quality_digest")).join(scores, "_quality_digest").select("lang", "held", "_quality_score.total", "_quality_score.symbols"))
    held = known.where("held")
    mean, limits = calibrate(known if held.where("symbols > 0").isEmpty() else held, known.where("not held"))
    name = F.coalesce("lang", F.lit(ANY))
    low, high = ({k: v[i] for k, v in limits.items()} for i in (0, 1))
    keep = F.coalesce(F.col("cross_entropy").between(_of_language(low, name), _of_language(high, name)), F.lit(False))
    rows = docs.drop("cross_entropy", "symbols", "keep").withColumn("_quality_digest", gram_join.digest())

    def judged(some: DataFrame) -> DataFrame:
        scored = some.join(scores, "_quality_digest", "left").withColumns({"cross_entropy": _filled(mean, name, "_quality_score."), "symbols": F.col("_quality_score.symbols")})
        return scored.withColumn("keep", keep).drop("_quality_score")

    if not only_kept:
        return judged(rows).drop("_quality_digest")
    rejected = cut(judged(rows.select("_quality_digest", name.alias("_quality_lang"), "lang").distinct()).where(~F.col("keep")).select("_quality_digest", "_quality_lang").distinct())
    few = rejected.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
    return rows.withColumn("_quality_lang", name).join(F.broadcast(rejected) if few else rejected, ["_quality_digest", "_quality_lang"], "left_anti").drop("_quality_digest", "_quality_lang")
