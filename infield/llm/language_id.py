"""Language identification with interpolated modified Kneser-Ney character models, one for each language.

Training counts the character 4-grams of every labelled training text in Spark but those of one text in SHARE, which
set the limits of the rejection. All n-grams stay; texts meet their counts by shard, and each shard keeps its part of
the models as sorted arrays (``gram_join``). A text's language is that of the least cross-entropy a character; it is
rejected if that lies above what texts of that language and length have that the models didn't learn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from infield.llm import gram_join
from infield.llm.char_lm import count_grams, letter_table
from infield.llm.common import MAX_BROADCAST_KEYS, cut

ORDER = 4
#: One in SHARE of the training texts, by hash, sets the limits: a limit is the QUANTILE of their cross-entropy over
#: their language's mean, in units of ``_spread``, plus MARGIN nats for what lies beyond it: higher quantiles of small
#: samples are single, perhaps mislabelled, texts. It is taken by language and length (powers of two) where ENOUGH
#: texts are there, else over all languages, or all lengths, or both.
SHARE, QUANTILE, MARGIN, ENOUGH = 8, 0.99, 0.25, 200
#: Languages of which the sample has fewer than FEW texts, and lengths without a limit, have NO_SAMPLE spreads and SLACK nats.
FEW, NO_SAMPLE, SLACK = 20, 4.0, 1.2
TOPIC = 400  #: characters after which a text's mean varies with its topic rather than by chance
LENGTHS = 32
UNKNOWN = "und"


@dataclass
class LanguageModels:
    languages: list[str]
    tables: gram_join.Tables
    mean: list[float]  #: of each language's cross-entropy a character
    deviation: list[float]  #: of the excess over the mean, in spreads of one character
    limits: list[list[float]]  #: of each language's excess over the mean, in spreads, by length
    slack: list[float]  #: that comes on top, in nats: MARGIN or SLACK


def _spread(deviation: Column, length: Column) -> Column:
    """How far the mean of a text of that many characters may well lie off."""
    return deviation * F.sqrt(1 / length + 1 / TOPIC)


def _length_class(length: Column) -> Column:
    return F.least(F.floor(F.log2(length)), F.lit(LENGTHS - 1)).cast("int")


def sampled(text: str = "text") -> Column:
    return F.pmod(F.xxhash64(text), F.lit(SHARE)) == 0  # equal texts stay together


def _values(pairs: dict[str, float], key: Column, default: float) -> Column:
    return F.coalesce(F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.lit(float(v)))])[key], F.lit(default)) if pairs else F.lit(default)


def train(df: DataFrame, lang: str = "lang", text: str = "text") -> LanguageModels:
    """Models of the languages of ``df``, with limits. Rows with a null language or an empty text teach nothing; no rows, no languages.

    A language all of whose texts are in the sample teaches by them as well.
    """
    rows = df.select(F.col(lang).cast("string").alias("model"), F.col(text).alias("text")).where("model is not null")
    counted = lambda some: count_grams(some, "model", "text", ORDER, letter_table)
    tables = gram_join.learn(counted(rows.where(~sampled())), ORDER)
    late = rows.where(sampled() & ~F.col("model").isin(tables.names) & (F.length("text") > 0))
    if not late.isEmpty():
        tables = gram_join.learn(tables.counts.unionByName(counted(late)), ORDER)
    if not tables.names:
        return LanguageModels([], tables, [], [], [], [])
    names = tables.names
    number = F.create_map(*[x for i, name in enumerate(names) for x in (F.lit(name), F.lit(i + 1))])[F.col("model")]

    def scored(some: DataFrame) -> DataFrame:
        found = some.select("model", gram_join.digest().alias("digest")).join(gram_join.sums(some, tables, letter_table), "digest").withColumn("of", number).where("symbols > 0 and of is not null")
        return cut(found.select("model", "symbols", (-F.element_at("totals", F.col("of"))).alias("total")))

    sample = scored(rows.where(sampled()))
    own = {r.model: r for r in sample.groupBy("model").agg(F.count("*").alias("n"), (F.sum("total") / F.sum("symbols")).alias("mean")).where(F.col("n") >= FEW).collect()}
    mean = {name: r["mean"] for name, r in own.items()}
    scarce = [name for name in names if name not in own]
    if scarce:  # what taught them has to do
        for r in scored(rows.where(F.col("model").isin(scarce))).groupBy("model").agg((F.sum("total") / F.sum("symbols")).alias("mean")).collect():
            mean[r.model] = r["mean"]
    excess = F.col("total") / F.col("symbols") - _values(mean, F.col("model"), 0.0)
    rest = sample.where(~F.col("model").isin(scarce)).withColumn("excess", excess)
    unit = 1 / F.col("symbols") + 1 / TOPIC
    deviation = {r.model: max(r.d, 1e-3) for r in rest.groupBy("model").agg(F.sqrt(F.avg(F.col("excess") ** 2 / unit)).alias("d")).collect()}
    z = rest.select("model", _length_class(F.col("symbols")).alias("class"), (F.col("excess") / _spread(_values(deviation, F.col("model"), 1.0), F.col("symbols"))).alias("z"))
    by_level = {(r.model, r["class"]): (r.n, r.z) for r in z.cube("model", "class").agg(F.count("*").alias("n"), F.percentile_approx("z", QUANTILE, 10000).alias("z")).collect()}

    def limit(name: str, k: int) -> float:
        levels = (by_level.get(key, (0, 0.0)) for key in ((name, k), (None, k), (name, None), (None, None)))
        return next((z for n, z in levels if n >= ENOUGH), NO_SAMPLE)

    usual = max(deviation.values(), default=1.0)
    return LanguageModels(
        names,
        tables,
        [mean.get(name, 0.0) for name in names],
        [deviation.get(name, usual) for name in names],
        [[NO_SAMPLE if name in scarce else limit(name, k) for k in range(LENGTHS)] for name in names],
        [SLACK if name in scarce else MARGIN for name in names],
    )


OUTPUTS = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("cross_entropy", T.DoubleType()),
        T.StructField("accepted", T.BooleanType()),
    ]
)


def predict(df: DataFrame, models: LanguageModels, text: str = "text", only_accepted: bool = False) -> DataFrame:
    """``df`` with lang_pred, score (0 to 1), cross_entropy (nats a character) and accepted, from the whole text alone.

    A null text, or one without a letter, is ``und`` with score 0 and not accepted; so is every text where no
    language was learned. A tie goes to the language that sorts first. Equal texts get equal answers. Input
    columns with these names are replaced, others stay. ``only_accepted`` keeps accepted rows only, without the new columns.
    """
    names = [f.name for f in OUTPUTS]
    rows = df.drop(*[n for n in names if n != text])
    if not models.languages:
        out = rows.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "cross_entropy": F.lit(None).cast("double"), "accepted": F.lit(False)})
        return out.where("accepted") if only_accepted else out
    languages, mean, deviation, slack = (F.array(*map(F.lit, x)) for x in (models.languages, models.mean, models.deviation, models.slack))
    limits = F.array(*[F.array(*map(F.lit, x)) for x in models.limits])
    length = F.col("symbols")
    entropy = F.transform("totals", lambda t: -t / length)
    least = F.col("cross_entropy")
    best = F.when(length > 0, F.array_position("entropy", least).cast("int"))
    gaps = F.aggregate("entropy", F.lit(0.0), lambda s, e: s + F.exp((least - e) * F.least(length, F.lit(64))))
    found = gram_join.sums(df, models.tables, letter_table, text).withColumn("entropy", F.when(length > 0, entropy)).withColumn("cross_entropy", F.array_min("entropy")).withColumn("best", best)
    of = F.col("best")
    limit = F.element_at(mean, of) + F.element_at(slack, of) + F.element_at(F.element_at(limits, of), _length_class(length) + 1) * _spread(F.element_at(deviation, of), length)
    said = found.select(
        F.col("digest").alias("_digest"),
        F.when(length > 0, F.element_at(languages, F.col("best"))).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(length > 0, 1 / gaps).otherwise(0.0).alias("score"),
        "cross_entropy",
        F.when(length > 0, least <= limit).otherwise(False).alias("accepted"),
    )
    rows = rows.withColumn("_digest", gram_join.digest(text))
    if not only_accepted:
        return rows.join(said, "_digest", "left").drop("_digest")
    rejected = said.where(~F.col("accepted")).select("_digest")
    few = rejected.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
    return rows.join(F.broadcast(rejected) if few else rejected, "_digest", "left_anti").drop("_digest")


def held_out(doc_id: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the id's decimal text leaves 2 when divided by 4; null ids are trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy and accepted of each document; trained on those not held out."""
    models = train(docs.where(~held_out()).select("lang", "text"))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), models).drop("text")
