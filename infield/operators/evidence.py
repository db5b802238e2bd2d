"""Evidence of insights as rows, checked for all candidates together; and the mechanical checks of posts that cite them.

A proof says which sums of a feature table, over which rows and days, give a number of a candidate again. Proofs of all
candidates are joined with their table once and added up in one aggregate, whatever their number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from infield.functions import columns as fx

TOLERANCE = 0.0005
BATTER, CONTACT, PITCH = "feature_batter_daily", "feature_contact_daily", "feature_pitch_daily"


def proof(role: str, expected: Column, source: str, top: str, bottom: str | None, first: Column, last: Column, player: Column | None = None, league: Column | None = None, pitch_type: Column | None = None, of_type: Column | None = None) -> Column:
    """``expected`` is sum(top) / sum(bottom) of ``source`` from ``first`` to ``last``, or sum(top) without ``bottom``.

    Rows are those of the player, of the league, or of both, and of ``pitch_type`` if given; ``of_type`` narrows the numerator alone.
    """
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    key = F.concat(F.lit("player:"), player) if player is not None else F.concat(F.lit("league:"), league)
    parts = {"role": F.lit(role), "expected": expected.cast("double"), "source": F.lit(source), "top": F.lit(top), "bottom": text(None if bottom is None else F.lit(bottom)), "key": key, "league": text(league), "pitch_type": text(pitch_type), "of_type": text(of_type), "first_dt": first.cast("string"), "last_dt": last.cast("string")}
    return F.struct(*[v.alias(k) for k, v in parts.items()])


def _measures(source: DataFrame) -> Column:
    """The table's numbers by name; of days with plate appearances also whether they had a hit."""
    numbers = {c: F.col(c).cast("double") for c, kind in source.dtypes if kind in ("bigint", "int", "double", "float") or kind.startswith("decimal")}
    if {"pa", "h"} <= numbers.keys():
        played = F.col("pa") > 0
        numbers |= {"hit_days": (played & (F.col("h") > 0)).cast("double"), "miss_days": (played & (F.col("h") <= 0)).cast("double")}
    return F.create_map(*[x for k, v in numbers.items() for x in (F.lit(k), v)])


def recomputed(candidates: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """A row for each proof of each candidate: role, expected, and ``again``, the same from the tables (null if nothing is there)."""
    proofs = candidates.select("insight_id", F.posexplode("evidence").alias("nth", "p")).select("insight_id", "nth", "p.*")
    sums = None
    for name, source in sources.items():
        none = {c: F.lit(None).cast("string") for c in ("pitch_type", "league_code") if c not in source.columns}
        typed = source.withColumns(none)
        ids = [F.concat(F.lit("player:"), F.col("player_id").cast("string"))] + ([F.concat(F.lit("league:"), "league_code")] if "league_code" in source.columns else [])
        rows = typed.select("dt", F.col("pitch_type").alias("_type"), F.col("league_code").alias("_league"), _measures(source).alias("_m"), F.explode(F.array(*ids)).alias("key"))
        met = rows.join(proofs.where(F.col("source") == name), "key").where(F.col("dt").between(F.col("first_dt"), F.col("last_dt")) & (F.col("pitch_type").isNull() | (F.col("_type") == F.col("pitch_type"))) & (F.col("league").isNull() | (F.col("_league") == F.col("league"))))
        top = F.when(F.col("of_type").isNull() | (F.col("_type") == F.col("of_type")), F.col("_m")[F.col("top")]).otherwise(0.0)
        own = met.groupBy("insight_id", "nth").agg(F.sum(top).alias("_top"), F.sum(F.col("_m")[F.col("bottom")]).alias("_bottom"))
        sums = own if sums is None else sums.unionByName(own)
    again = F.when(F.col("bottom").isNull(), F.col("_top")).otherwise(fx.ratio("_top", "_bottom"))
    return proofs.join(sums, ["insight_id", "nth"], "left").select("insight_id", "nth", "role", "expected", again.alias("again"))


def verified(candidates: DataFrame, sources: Mapping[str, DataFrame], claims: DataFrame | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """insight_id, checks, wrong and verified of every candidate: whether all its proofs give their numbers again.

    ``claims`` (insight_id, claim) are numbers that somebody states as the candidate's value; a wrong one is wrong, too.
    """
    found = recomputed(candidates, sources)
    close = lambda a, b: F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))
    wrong = ~close(F.col("again"), F.col("expected"))
    if claims is not None:
        found = found.join(claims.select("insight_id", F.col("claim").cast("double").alias("claim")), "insight_id", "left")
        wrong = wrong | ((F.col("role") == "value") & F.col("claim").isNotNull() & ~close(F.col("again"), F.col("claim")))
    counted = found.groupBy("insight_id").agg(F.count("*").alias("checks"), F.count_if(wrong).alias("wrong"))
    out = candidates.select("insight_id").join(counted, "insight_id", "left")
    return out.select("insight_id", F.coalesce("checks", F.lit(0)).alias("checks"), F.coalesce("wrong", F.lit(0)).alias("wrong"), F.coalesce((F.col("checks") > 0) & (F.col("wrong") == 0), F.lit(False)).alias("verified"))


def named(candidates: DataFrame, players: DataFrame) -> DataFrame:
    """``candidates`` with subject_name: a player's name (the greatest, if there are several), null if unknown; other subjects' own id."""
    names = players.where(F.col("primary_name").isNotNull()).groupBy(F.col("player_id").alias("subject_id")).agg(F.max("primary_name").alias("_name"))
    return candidates.join(names, "subject_id", "left").withColumn("subject_name", F.when(F.col("subject_type") == "player", F.col("_name")).otherwise(F.col("subject_id"))).drop("_name").select(*candidates.columns, "subject_name")


#: Words that claim a rank, and the length of a post.
RANKING = ["best", "worst", "most", "least", "highest", "lowest", "leads", "leading", "led", "only", "first", "record", "top", "fewest"]
LONGEST = 280
_NUMBER = r"(?<![\w.])(\d+(?:\.\d+)?|\.\d+)"


def check_findings(findings: DataFrame, candidates: DataFrame, checked: DataFrame, taken: Sequence[str] = (), since: str | None = None) -> DataFrame:
    """``findings`` (finding_id, post, subjects, cites) with ``problems``, none if the post may stand.

    ``candidates`` are named(), ``checked`` is verified(). A post may state numbers of the insights that it cites: their
    values, sizes, facts and dates, as they are, without sign or as percentages, rounded to the places that it writes. Its
    subjects are named in it and in what it cites, and are not among ``taken``. A ranking word needs an insight that is the
    first of its detector. Data that begin after a season's opening (``since``) carry no word on the season.
    Problems of what is cited, of numbers and of subjects come first, those of the post's form after them.
    """
    numbers = lambda c: F.transform(F.regexp_extract_all(c, F.lit(_NUMBER), F.lit(1)), lambda x: x.cast("double"))
    told = F.array_compact(F.array(*[F.col(c).cast("double") for c in ("value", "baseline", "delta", "sample_size")]))
    facts = candidates.join(checked.select("insight_id", "verified"), "insight_id", "left").select(
        "insight_id", "subject_name", "rank", F.coalesce("verified", F.lit(False)).alias("verified"), F.concat(told, numbers(F.translate("facts_json", "-", " ")), numbers(F.translate("dt", "-", " "))).alias("numbers")
    )
    cited = findings.select("finding_id", F.explode("cites").alias("insight_id")).distinct().join(facts, "insight_id", "left").withColumn("known", F.col("numbers").isNotNull())
    per = cited.groupBy("finding_id").agg(
        F.sort_array(F.collect_list(F.when(~F.col("known"), F.col("insight_id")))).alias("unknown"), F.sort_array(F.collect_list(F.when(F.col("known") & ~F.col("verified"), F.col("insight_id")))).alias("refuted"),
        F.flatten(F.collect_list("numbers")).alias("numbers"), F.collect_set(F.lower("subject_name")).alias("names"), F.min("rank").alias("rank"),
    )
    empty = F.array().cast("array<string>")
    rows = findings.join(per, "finding_id", "left").withColumns({"_unknown": F.coalesce("unknown", empty), "_refuted": F.coalesce("refuted", empty), "_names": F.coalesce("names", empty), "_subjects": F.coalesce("subjects", empty), "_post": F.coalesce("post", F.lit(""))})
    allowed = F.flatten(F.transform(F.coalesce("numbers", F.array().cast("array<double>")), lambda x: F.array(F.abs(x), F.abs(x) * 100)))
    written = F.regexp_extract_all("_post", F.lit(_NUMBER), F.lit(1))
    places = lambda x: F.length(F.regexp_extract(x, r"\.(\d+)$", 1))
    near = lambda x: F.exists(allowed, lambda a: F.abs(a - x.cast("double")) <= 0.5 * F.pow(F.lit(10.0), -places(x)) + 1e-9)
    post = F.lower("_post")
    ranks = F.filter(F.array(*[F.lit(w) for w in RANKING]), lambda w: F.rlike(F.col("_post"), F.concat(F.lit(r"(?i)\b"), w, F.lit(r"\b"))))
    season = F.lit(False) if since is None or since[4:] in ("-03-25", "-03-26", "-03-27", "-03-28") else post.rlike(r"\bseason\b|\bin 20\d\d\b")
    problem = lambda bad, text: F.when(bad, text if isinstance(text, Column) else F.lit(text))
    each = lambda values, text: F.transform(values, lambda v: F.concat(F.lit(text), v))
    covered = [w.lower() for w in taken if w.lower() not in ("mlb", "npb", "kbo")]
    one = F.array_compact(F.array(
        problem(F.size(F.coalesce("cites", empty)) == 0, "cites nothing"),
        problem(F.length("_post") > LONGEST, F.concat(F.length("_post").cast("string"), F.lit(f" characters; the limit is {LONGEST}"))),
        problem(F.contains("_post", F.lit("#")), "no hashtags"),
        problem((F.size(ranks) > 0) & F.coalesce(F.col("rank") > 1, F.lit(True)), F.concat(F.lit("a ranking word needs a first rank: "), F.array_join(ranks, ", "))),
        problem(season, f"says season, but the data begin {since}"),
    ))
    lists = [
        each("_unknown", "unknown evidence: "), each("_refuted", "evidence that doesn't hold: "), each(F.filter(written, lambda x: ~near(x)), "number not in the evidence: "),
        each(F.filter("_subjects", lambda s: (F.trim(s) != "") & ~F.array_contains(F.col("_names"), F.lower(F.trim(s)))), "subject not in the evidence: "), each(F.filter("_subjects", lambda s: (F.trim(s) != "") & ~F.contains(post, F.lower(F.trim(s)))), "subject not named: "),
        each(F.filter("_subjects", lambda s: F.lower(F.trim(s)).isin(covered) if covered else F.lit(False)), "already covered: "),
    ]
    return rows.withColumn("problems", F.concat(*lists, one)).select(*findings.columns, "problems")
