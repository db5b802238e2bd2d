"""Insight detectors: streaks, changes against a baseline, league shifts and gaps, luck, new pitches, velocity, drivers.

Each detector returns candidates of one schema, with the evidence query that gives the same numbers again.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from infield.functions import columns as fx
from infield.operators.evidence import BATTER, CONTACT, PITCH, proof
from infield.operators.relational import streaks
from infield.plans.guard import guarded

#: Thresholds of the detectors.
THRESHOLDS = {
    "hitting_streak": {"min_games": 10, "max_days_since_last_game": 3},
    "change_vs_baseline": {"recent_days": 14, "min_recent_pa": 40, "min_baseline_pa": 150, "min_abs_z": 2.5, "woba_sd_per_pa": 0.5},
    "league_month_shift": {"min_month_pa": 3000, "min_abs_z": 3.0},
    "cross_league_gap": {"min_season_pa": 10000, "min_abs_z": 4.0},
    "luck_gap": {"min_pa": 200, "min_abs_gap": 0.040},
    "new_pitch": {"recent_days": 30, "min_early_pitches": 400, "min_recent_pitches": 250, "max_early_share": 0.03, "min_recent_share": 0.12, "min_xwoba_improvement": 0.020},
    "velocity_change": {"recent_days": 30, "pitch_types": ["FF", "SI"], "min_pitches": 150, "min_abs_mph": 1.5},
}
TOP = 10
RATES = {"k_rate": "so", "bb_rate": "bb", "hr_rate": "hr"}


def candidate(rows: DataFrame, detector: str, as_of: str, league: Column, subject_type: str, subject: Column, metric: Column, value: Column, baseline: Column | None, size: Column, score: Column, facts: Mapping[str, Column], evidence: Column, *proofs: Column) -> DataFrame:
    none = F.lit(None).cast("double")
    return rows.select(
        fx.short_hash(F.lit(detector), F.lit(as_of), league, subject, metric).alias("insight_id"), F.lit(detector).alias("detector"), league.alias("league_code"), F.lit(subject_type).alias("subject_type"), subject.alias("subject_id"), metric.alias("metric"), fx.rounded(value, 4).alias("value"),
        (none if baseline is None else fx.rounded(baseline, 4)).alias("baseline"), (none if baseline is None else fx.rounded(value.cast("double") - baseline, 4)).alias("delta"), size.cast("long").alias("sample_size"), F.round(score.cast("double"), 3).alias("score"),
        F.to_json(F.struct(*[c.alias(k) for k, c in sorted(facts.items())])).alias("facts_json"), evidence.alias("evidence_sql"), F.array(*proofs).alias("evidence"), F.lit(as_of).alias("dt"),
    )


def _days(as_of: str, recent: int) -> tuple[str, str]:
    day = date.fromisoformat(as_of)
    return f"{day.year}-01-01", (day - timedelta(days=recent - 1)).isoformat()


def _both(value: str, baseline: str, source: str, top: str, bottom: str, start: str, split: str, as_of: str, **rows: Column) -> list[Column]:
    """Proofs of a value of the days since ``split`` and of the baseline before it."""
    before = (date.fromisoformat(split) - timedelta(days=1)).isoformat()
    return [proof("value", F.round(value, 4), source, top, bottom, F.lit(split), F.lit(as_of), **rows), proof("baseline", F.round(baseline, 4), source, top, bottom, F.lit(start), F.lit(before), **rows)]


def _rate_proofs(role: str, expected: Column, league: Column, first: Column, last: Column) -> Column:
    """The proof of whichever rate a row is about."""
    return fx.first_match([(F.col("metric") == m, proof(role, F.round(expected, 4), BATTER, c, "pa", first, last, league=league)) for m, c in RATES.items()], None)


def _text(template: str, *cols: Column | str) -> Column:
    return F.format_string(template, *cols)


def hitting_streaks(daily: DataFrame, as_of: str, cfg: Mapping) -> DataFrame:
    games = daily.where((F.col("pa") > 0) & (F.col("dt") <= as_of))
    runs = streaks(games, ["player_id"], ["dt"], F.col("h") > 0, "dt")
    last = games.groupBy("player_id").agg(F.max("dt").alias("end_dt"), F.max_by("league_code", "dt").alias("league_code"))
    since = F.date_sub(F.to_date(F.lit(as_of)), cfg["max_days_since_last_game"]).cast("string")
    rows = runs.join(last, ["player_id", "end_dt"]).where((F.col("length") >= cfg["min_games"]) & (F.col("end_dt") >= since))
    n = F.col("length")
    sql = _text("SELECT dt, pa, h FROM feature_batter_daily WHERE player_id = '%s' AND dt BETWEEN '%s' AND '%s' AND pa > 0 ORDER BY dt", "player_id", "start_dt", "end_dt")
    span = {"player": F.col("player_id"), "first": F.col("start_dt"), "last": F.col("end_dt")}
    proofs = [proof("value", n, BATTER, "hit_days", None, **span), proof("unbroken", F.lit(0.0), BATTER, "miss_days", None, **span)]
    return candidate(rows, "hitting_streak", as_of, F.col("league_code"), "player", F.col("player_id"), F.lit("hitting_streak_games"), n, None, n, n, {"games": n, "start_dt": F.col("start_dt"), "end_dt": F.col("end_dt"), "active": F.lit(True)}, sql, *proofs)


def change_vs_baseline(daily: DataFrame, as_of: str, cfg: Mapping) -> DataFrame:
    start, split = _days(as_of, cfg["recent_days"])
    recent = F.col("dt") >= split
    # daily values have six places by definition, so their sums are exact as decimals, whatever the order of the rows
    exact = lambda c: F.col(c).cast("decimal(38,6)") if c == "woba_value" else F.col(c)
    part = lambda c, when: F.sum(F.when(when, exact(c)).otherwise(0))
    sums = daily.where(F.col("dt").between(start, as_of)).groupBy("player_id", "league_code").agg(*[part(c, w).alias(f"{n}_{c}") for n, w in (("recent", recent), ("base", ~recent)) for c in ("pa", "woba_value", "woba_den")])
    now, was = fx.ratio("recent_woba_value", "recent_woba_den"), fx.ratio("base_woba_value", "base_woba_den")
    z = fx.mean_z(now, F.nullif(F.col("recent_woba_den"), F.lit(0)), was, F.nullif(F.col("base_woba_den"), F.lit(0)), cfg["woba_sd_per_pa"])
    rows = sums.withColumns({"now": now, "was": was, "z": z}).where((F.col("recent_pa") >= cfg["min_recent_pa"]) & (F.col("base_pa") >= cfg["min_baseline_pa"]) & (F.abs("z") >= cfg["min_abs_z"]))
    sql = _text(f"SELECT CASE WHEN dt >= '{split}' THEN 'recent' ELSE 'baseline' END AS span, sum(pa) AS pa, sum(woba_value) / sum(woba_den) AS woba FROM feature_batter_daily WHERE player_id = '%s' AND dt BETWEEN '{start}' AND '{as_of}' GROUP BY 1", "player_id")
    facts = {"direction": F.when(F.col("z") > 0, "up").otherwise("down"), "recent_days": F.lit(cfg["recent_days"]), "recent_pa": F.col("recent_pa"), "baseline_pa": F.col("base_pa"), "z": F.round("z", 2)}
    return candidate(rows, "change_vs_baseline", as_of, F.col("league_code"), "player", F.col("player_id"), F.lit("woba"), F.col("now"), F.col("was"), F.col("recent_pa"), F.abs("z"), facts, sql, *_both("now", "was", BATTER, "woba_value", "woba_den", start, split, as_of, player=F.col("player_id"), league=F.col("league_code")))


def league_months(daily: DataFrame, as_of: str) -> DataFrame:
    start, _ = _days(as_of, 1)
    return daily.where(F.col("dt").between(start, as_of)).groupBy("league_code", F.substring("dt", 1, 7).alias("month")).agg(*[F.sum(c).alias(c) for c in ("pa", "so", "bb", "hr")])


def _rates(rows: DataFrame, keys: list[str], sides: tuple[str, str]) -> DataFrame:
    """A row for each rate, with both sides' count and size, and z."""
    a, b = sides
    rate = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{a}_{c}").alias("x1"), F.col(f"{b}_{c}").alias("x2")) for m, c in RATES.items()])
    each = rows.select(*keys, F.col(f"{a}_pa").alias("n1"), F.col(f"{b}_pa").alias("n2"), F.explode(rate).alias("r")).select(*keys, "n1", "n2", "r.*")
    return each.withColumn("z", fx.proportion_z(F.col("x1"), F.col("n1"), F.col("x2"), F.col("n2")))


def league_month_shift(daily: DataFrame, as_of: str, cfg: Mapping) -> DataFrame:
    months = league_months(daily, as_of).where(F.col("pa") >= cfg["min_month_pa"])
    w = Window.partitionBy("league_code").orderBy("month")
    both = months.select("league_code", "month", F.lag("month").over(w).alias("previous"), F.lead("month").over(w).isNull().alias("newest"), *[F.col(c).alias("now_" + c) for c in ("pa", "so", "bb", "hr")], *[F.lag(c).over(w).alias("was_" + c) for c in ("pa", "so", "bb", "hr")])
    rows = _rates(both.where("newest and previous is not null"), ["league_code", "month", "previous"], ("now", "was")).where(F.abs("z") >= cfg["min_abs_z"])
    sql = _text("SELECT substr(dt, 1, 7) AS month, sum(so) / sum(pa) AS k_rate, sum(bb) / sum(pa) AS bb_rate, sum(hr) / sum(pa) AS hr_rate FROM feature_batter_daily WHERE league_code = '%s' AND substr(dt, 1, 7) IN ('%s', '%s') GROUP BY 1", "league_code", "previous", "month")
    span = lambda m: (F.greatest(F.concat(m, F.lit("-01")), F.lit(_days(as_of, 1)[0])), F.least(F.concat(m, F.lit("-31")), F.lit(as_of)))
    proofs = [_rate_proofs(role, fx.ratio(x, n), F.col("league_code"), *span(F.col(m))) for role, x, n, m in (("value", "x1", "n1", "month"), ("baseline", "x2", "n2", "previous"))]
    facts = {"month": F.col("month"), "previous_month": F.col("previous"), "month_pa": F.col("n1"), "previous_pa": F.col("n2"), "z": F.round("z", 2)}
    return candidate(rows, "league_month_shift", as_of, F.col("league_code"), "league", F.col("league_code"), F.col("metric"), fx.ratio("x1", "n1"), fx.ratio("x2", "n2"), F.col("n1"), F.abs("z"), facts, sql, *proofs)


def cross_league_gap(daily: DataFrame, as_of: str, cfg: Mapping) -> DataFrame:
    """Unordered pairs of leagues; a league is a row after aggregation, so the pairs are few whatever the data."""
    season = league_months(daily, as_of).groupBy("league_code").agg(*[F.sum(c).alias(c) for c in ("pa", "so", "bb", "hr")]).where(F.col("pa") >= cfg["min_season_pa"])
    side = lambda p: season.select(F.col("league_code").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in ("pa", "so", "bb", "hr")])
    rows = _rates(side("a").join(side("b"), F.col("a") < F.col("b")), ["a", "b"], ("a", "b")).where(F.abs("z") >= cfg["min_abs_z"])
    pair = F.concat_ws("-", "a", "b")
    proofs = [_rate_proofs(role, fx.ratio(x, n), F.col(side), F.lit(f"{as_of[:4]}-01-01"), F.lit(as_of)) for role, x, n, side in (("value", "x1", "n1", "a"), ("baseline", "x2", "n2", "b"))]
    sql = _text(f"SELECT league_code, sum(so) / sum(pa) AS k_rate, sum(bb) / sum(pa) AS bb_rate, sum(hr) / sum(pa) AS hr_rate FROM feature_batter_daily WHERE league_code IN ('%s', '%s') AND dt BETWEEN '{as_of[:4]}-01-01' AND '{as_of}' GROUP BY 1", "a", "b")
    return candidate(rows, "cross_league_gap", as_of, pair, "league_pair", pair, F.col("metric"), fx.ratio("x1", "n1"), fx.ratio("x2", "n2"), F.least("n1", "n2"), F.abs("z"), {"z": F.round("z", 2), "season": F.lit(int(as_of[:4]))}, sql, *proofs)


def luck_gap(contact: DataFrame, as_of: str, cfg: Mapping) -> DataFrame:
    start, _ = _days(as_of, 1)
    sums = contact.where(F.col("dt").between(start, as_of)).groupBy("player_id").agg(*[F.sum(c).alias(c) for c in ("woba_value", "xwoba_value", "woba_den", "bip", "babip_hits", "xwoba_bip_n")])
    rows = sums.withColumns({"woba": fx.ratio("woba_value", "woba_den"), "xwoba": fx.ratio("xwoba_value", "woba_den")}).withColumn("gap", F.col("woba") - F.col("xwoba"))
    rows = rows.where((F.col("woba_den") >= cfg["min_pa"]) & (F.col("xwoba_bip_n") > 0) & (F.abs("gap") >= cfg["min_abs_gap"]))
    sql = _text(f"SELECT sum(woba_value) / sum(woba_den) AS woba, sum(xwoba_value) / sum(woba_den) AS xwoba, sum(woba_den) AS pa FROM feature_contact_daily WHERE player_id = '%s' AND dt BETWEEN '{start}' AND '{as_of}'", "player_id")
    proofs = [proof(role, F.round(c, 4), CONTACT, f"{c}_value", "woba_den", F.lit(start), F.lit(as_of), player=F.col("player_id")) for role, c in (("value", "woba"), ("baseline", "xwoba"))]
    facts = {"direction": F.when(F.col("gap") > 0, "lucky").otherwise("unlucky"), "babip": F.round(fx.ratio("babip_hits", "bip"), 4), "pa": F.col("woba_den").cast("long")}
    return candidate(rows, "luck_gap", as_of, F.lit("MLB"), "player", F.col("player_id"), F.lit("woba_minus_xwoba"), F.col("woba"), F.col("xwoba"), F.col("woba_den"), F.abs("gap") * F.sqrt("woba_den"), facts, sql, *proofs)


def pitcher_spans(pitches: DataFrame, as_of: str, recent: int) -> DataFrame:
    """Sums by pitcher and pitch type, early and recent side by side."""
    start, split = _days(as_of, recent)
    late = F.col("dt") >= split
    cols = ["pitches", "swings", "whiffs", "velo_sum", "velo_n", "xwoba_value", "woba_den"]
    return pitches.where(F.col("dt").between(start, as_of)).groupBy("player_id", "pitch_type").agg(*[F.sum(F.when(w, F.col(c)).otherwise(0)).alias(f"{n}_{c}") for n, w in (("early", ~late), ("recent", late)) for c in cols])


def new_pitch(pitches: DataFrame, as_of: str, cfg: Mapping) -> DataFrame:
    _, split = _days(as_of, cfg["recent_days"])
    w = Window.partitionBy("player_id")
    total = {f"all_{n}_{c}": F.sum(f"{n}_{c}").over(w) for n in ("early", "recent") for c in ("pitches", "swings", "whiffs", "xwoba_value", "woba_den")}
    t = pitcher_spans(pitches, as_of, cfg["recent_days"]).withColumns(total)
    per = {f"{o}_{n}": fx.ratio(f"all_{n}_{a}", f"all_{n}_{b}") for n in ("early", "recent") for o, a, b in (("whiff", "whiffs", "swings"), ("xwoba", "xwoba_value", "woba_den"))}
    t = t.withColumns(per).withColumns({f"share_{n}": fx.ratio(f"{n}_pitches", f"all_{n}_pitches") for n in ("early", "recent")})
    better = F.col("xwoba_early") - F.col("xwoba_recent")
    rows = t.where((F.col("all_early_pitches") >= cfg["min_early_pitches"]) & (F.col("all_recent_pitches") >= cfg["min_recent_pitches"]) & (better >= cfg["min_xwoba_improvement"]) & F.col("whiff_early").isNotNull() & F.col("whiff_recent").isNotNull() & (F.col("share_early") <= cfg["max_early_share"]) & (F.col("share_recent") >= cfg["min_recent_share"]))
    score = (F.col("share_recent") - F.col("share_early")) * 10 + F.greatest(F.lit(0.0), better) * 10 + F.greatest(F.lit(0.0), F.col("whiff_recent") - F.col("whiff_early")) * 5
    sql = _text(f"SELECT dt >= '{split}' AS since, sum(CASE WHEN pitch_type = '%s' THEN pitches ELSE 0 END) / sum(pitches) AS share FROM feature_pitch_daily WHERE player_id = '%s' AND dt BETWEEN '{as_of[:4]}-01-01' AND '{as_of}' GROUP BY 1", "pitch_type", "player_id")
    facts = {"pitch_type": F.col("pitch_type"), "since": F.lit(split), "whiff_rate_before": F.round("whiff_early", 4), "whiff_rate_since": F.round("whiff_recent", 4), "xwoba_against_before": F.round("xwoba_early", 4), "xwoba_against_since": F.round("xwoba_recent", 4)}
    return candidate(rows, "new_pitch", as_of, F.lit("MLB"), "player", F.col("player_id"), F.concat(F.lit("pitch_share:"), "pitch_type"), F.col("share_recent"), F.col("share_early"), F.col("all_recent_pitches"), score, facts, sql, *_both("share_recent", "share_early", PITCH, "pitches", "pitches", f"{as_of[:4]}-01-01", split, as_of, player=F.col("player_id"), of_type=F.col("pitch_type")))


def velocity_change(pitches: DataFrame, as_of: str, cfg: Mapping) -> DataFrame:
    _, split = _days(as_of, cfg["recent_days"])
    t = pitcher_spans(pitches, as_of, cfg["recent_days"]).where(F.col("pitch_type").isin(*cfg["pitch_types"]))
    t = t.withColumns({n: fx.ratio(f"{n}_velo_sum", f"{n}_velo_n") for n in ("early", "recent")}).withColumn("change", F.col("recent") - F.col("early"))
    rows = t.where((F.col("early_velo_n") >= cfg["min_pitches"]) & (F.col("recent_velo_n") >= cfg["min_pitches"]) & (F.abs("change") >= cfg["min_abs_mph"]))
    sql = _text(f"SELECT dt >= '{split}' AS since, sum(velo_sum) / sum(velo_n) AS velo FROM feature_pitch_daily WHERE player_id = '%s' AND pitch_type = '%s' AND dt BETWEEN '{as_of[:4]}-01-01' AND '{as_of}' GROUP BY 1", "player_id", "pitch_type")
    facts = {"pitch_type": F.col("pitch_type"), "direction": F.when(F.col("change") > 0, "up").otherwise("down"), "since": F.lit(split), "pitches_before": F.col("early_velo_n"), "pitches_since": F.col("recent_velo_n")}
    return candidate(rows, "velocity_change", as_of, F.lit("MLB"), "player", F.col("player_id"), F.concat(F.lit("velo:"), "pitch_type"), F.col("recent"), F.col("early"), F.col("recent_velo_n"), F.abs("change"), facts, sql, *_both("recent", "early", PITCH, "velo_sum", "velo_n", f"{as_of[:4]}-01-01", split, as_of, player=F.col("player_id"), pitch_type=F.col("pitch_type")))


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """The best of each detector, its directions in turn, numbered from 1."""
    side = F.coalesce(F.get_json_object("facts_json", "$.direction"), F.lit(""))
    w = Window.partitionBy("detector", "_side").orderBy(F.desc("score"), "insight_id")
    rows = found.withColumn("_side", side).withColumn("_round", F.row_number().over(w)).withColumn("_best", F.first("score").over(w)).where(F.col("_round") <= top)
    order = Window.partitionBy("detector").orderBy("_round", F.desc("_best"), "_side")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).drop("_side", "_round", "_best")


def detect(daily: DataFrame, contact: DataFrame, pitches: DataFrame, as_of: str, thresholds: Mapping[str, Mapping] = THRESHOLDS, top: int = TOP) -> DataFrame:
    """All detectors' candidates, ranked."""
    sources = {"luck_gap": contact, "new_pitch": pitches, "velocity_change": pitches}
    makers = {f.__name__: f for f in (change_vs_baseline, league_month_shift, cross_league_gap, luck_gap, new_pitch, velocity_change)} | {"hitting_streak": hitting_streaks}
    found = [makers[name](sources.get(name, daily), as_of, cfg) for name, cfg in thresholds.items()]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return ranked(out, top)


# Verification -------------------------------------------------------------------------------------------

TOLERANCE = 0.0005


def recomputed(evidence: DataFrame, detector: str, metric: str, facts: Mapping) -> float | None:
    """A candidate's value again, from the rows of its evidence query (a handful)."""
    rows = evidence.collect()
    if detector == "hitting_streak":
        return float(len(rows)) if rows and all(r.h > 0 for r in rows) else None
    pick = {
        "change_vs_baseline": ("woba", lambda r: r["span"] == "recent"), "league_month_shift": (metric, lambda r: r["month"] == facts.get("month")), "cross_league_gap": (metric, lambda r: r["league_code"] == facts.get("first")),
        "luck_gap": ("woba", lambda r: True), "new_pitch": ("share", lambda r: r["since"]), "velocity_change": ("velo", lambda r: r["since"]),
    }
    column, wanted = pick[detector]
    found = [r[column] for r in rows if wanted(r)]
    return float(found[0]) if found and found[0] is not None else None


def verified(spark: SparkSession, row: Row, claim: float | None = None) -> bool:
    """Whether a candidate's evidence gives its value again, and a claim about it, within TOLERANCE. Only read-only queries run."""
    facts = json.loads(row.facts_json) | {"first": row.league_code.split("-")[0]}
    again = recomputed(spark.sql(guarded(spark, row.evidence_sql)), row.detector, row.metric, facts)
    return again is not None and abs(again - row.value) <= TOLERANCE and (claim is None or abs(again - claim) <= TOLERANCE)
