"""Why a player's results changed: statistics of two spans or of a player and the league, compared all at once.

A statistic is a row of a table: its sums, its kind (a proportion or a mean of known spread) and how much of it both sides
need. Sums of both sides lie side by side in a row for each player; the statistics are unpivoted once, scored against
sampling noise, and the clearest are kept.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from infield.functions import columns as fx
from infield.operators.pitch_features import COMPONENTS

PROPORTION, MEAN = "proportion", "mean"


@dataclass(frozen=True)
class Statistic:
    name: str
    label: str
    top: str
    bottom: str
    least: int  #: of ``bottom`` on both sides
    kind: str = PROPORTION
    spread: float = 0.0  #: standard deviation of one observation, of a mean
    places: int = 4


#: The statistics of pitches, their labels, spreads and least sizes.
STATISTICS = (
    Statistic("chase_rate", "chase rate (swings at pitches outside the zone)", "chase_swings", "chase_pitches", 60),
    Statistic("zone_swing_rate", "swing rate on pitches in the zone", "zone_swings", "zone_pitches", 60),
    Statistic("whiff_rate", "whiff rate (misses per swing)", "whiffs", "swings", 60),
    Statistic("hard_hit_rate", "hard-hit rate (95+ mph balls in play)", "hard_hit", "bip", 25),
    Statistic("barrel_rate", "barrel rate (per ball in play)", "barrels", "bip", 25),
    Statistic("pull_rate", "pull rate (per ball in play)", "pulled", "bip", 25),
    Statistic("pulled_air_rate", "pulled line drives and fly balls (per ball in play)", "pulled_air", "bip", 25),
    Statistic("ground_ball_rate", "ground-ball rate", "gb", "bip", 25),
    Statistic("fly_ball_rate", "fly-ball rate", "fb", "bip", 25),
    Statistic("avg_exit_velo", "average exit velocity (mph)", "ev_sum", "ev_n", 25, MEAN, 15.0, 1),
    Statistic("avg_launch_angle", "average launch angle (degrees)", "la_sum", "la_n", 25, MEAN, 25.0, 1),
    Statistic("xwoba", "xwOBA", "xwoba_value", "woba_den", 20, MEAN, 0.5, 3),
)
#: Which statistics tell something against a pitch group, the league, a pitcher and for one of their pitches.
BY_GROUP = {"chase_rate", "whiff_rate", "hard_hit_rate", "xwoba"}
VS_LEAGUE = {"hard_hit_rate", "barrel_rate", "avg_exit_velo", "avg_launch_angle", "pull_rate", "ground_ball_rate", "fly_ball_rate", "xwoba"}
OF_PITCHER = {"chase_rate", "whiff_rate", "hard_hit_rate", "barrel_rate", "avg_exit_velo", "ground_ball_rate", "xwoba"}
OF_PITCH = {"chase_rate", "whiff_rate", "xwoba"}
GROUP_LABEL = {"fastball": "fastballs", "breaking": "breaking balls", "offspeed": "offspeed pitches"}
SUMS = [c.name for c in COMPONENTS]
TOP, LEAST_Z = 3, 2.0


def sides(now: Column, then: Column, columns: Collection[str] = tuple(SUMS)) -> list[Column]:
    """Sums of rows that are on one side, and of those on the other."""
    return [F.sum(F.when(on, F.col(c)).otherwise(0)).cast("double").alias(f"{name}_{c}") for name, on in (("since", now), ("before", then)) for c in columns]


def compared(rows: DataFrame, keys: Sequence[str], statistics: Sequence[Statistic] = STATISTICS) -> DataFrame:
    """A row for each statistic of each row of sides() that has enough of it: both values, both sizes and z.

    ``nth`` is the statistic's place in the table, which breaks ties.
    """
    side = lambda s, c: F.col(f"{s}_{c}").cast("double")
    each = F.array(*[
        F.struct(F.lit(i).alias("nth"), F.lit(s.name).alias("metric"), F.lit(s.label).alias("label"), F.lit(s.kind).alias("kind"), F.lit(s.spread).alias("spread"), F.lit(s.least).alias("least"), F.lit(s.places).alias("places"),
                 side("since", s.top).alias("x1"), side("since", s.bottom).alias("n1"), side("before", s.top).alias("x2"), side("before", s.bottom).alias("n2"))
        for i, s in enumerate(statistics)
    ])
    flat = rows.select(*keys, F.explode(each).alias("s")).select(*keys, "s.*").where("n1 >= least and n2 >= least and n1 > 0 and n2 > 0")
    since, before = F.col("x1") / F.col("n1"), F.col("x2") / F.col("n2")
    pooled = (F.col("x1") + F.col("x2")) / (F.col("n1") + F.col("n2"))
    deviation = F.when(F.col("kind") == PROPORTION, F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(1e-9)))).otherwise(F.col("spread"))
    z = (since - before) / (deviation * F.sqrt(1 / F.col("n1") + 1 / F.col("n2")))
    shown = lambda c: fx.first_match([(F.col("places") == p, F.round(c, p)) for p in sorted({s.places for s in statistics})], None)
    return flat.select(*keys, "nth", "metric", "label", shown(since).alias("since"), shown(before).alias("before"), F.col("n1").cast("long").alias("n_since"), F.col("n2").cast("long").alias("n_before"), F.round(z, 2).alias("z"))


def clearest(found: DataFrame, keys: Sequence[str], top: int = TOP, least: float = LEAST_Z) -> DataFrame:
    """The ``top`` of each key by absolute z, ``least`` at least, numbered; ties by place."""
    w = Window.partitionBy(*keys).orderBy(F.desc(F.abs("z")), "nth")
    return found.where(F.abs("z") >= least).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def _season(as_of: str) -> Column:
    return F.col("dt").between(f"{as_of[:4]}-01-01", as_of)


def _none() -> Column:
    return F.lit(None).cast("string")


def batter_change(features: DataFrame, splits: DataFrame, as_of: str, top: int = TOP, least: float = LEAST_Z) -> DataFrame:
    """What changed in batters' play since their split (``splits``: player_id, since), overall and by pitch group.

    ``features`` is feature_batter_pitch_daily; one pass makes the sums of all batters, with and without the group.
    """
    rows = features.where(_season(as_of)).join(splits, "player_id")
    late = F.col("dt") >= F.col("since")
    rows = rows.withColumns({"_late": late})
    keys = ["player_id", "since"]
    sums = rows.groupingSets([[F.col(k) for k in keys], [F.col(k) for k in (*keys, "pitch_group")]], *[F.col(k) for k in (*keys, "pitch_group")]).agg(F.grouping("pitch_group").alias("_all"), *sides(F.col("_late"), ~F.col("_late")))
    found = compared(sums.withColumnRenamed("since", "split"), ["player_id", "split", "pitch_group", "_all"])
    label = fx.first_match([(F.col("pitch_group") == g, F.lit(f" against {t}")) for g, t in GROUP_LABEL.items()], None)
    overall, group = F.col("_all") == 1, label.isNotNull() & F.col("metric").isin(*BY_GROUP)
    order = F.when(overall, 0).otherwise(fx.first_match([(F.col("pitch_group") == g, i + 1) for i, g in enumerate(GROUP_LABEL)], None))
    named = found.where(overall | group).select("player_id", (order * 100 + F.col("nth")).alias("nth"), F.when(overall, F.col("metric")).otherwise(F.concat_ws("_", "pitch_group", "metric")).alias("metric"), F.when(overall, F.col("label")).otherwise(F.concat("label", label)).alias("label"), "since", "before", "n_since", "n_before", "z", _none().alias("vs"))
    return clearest(named, ["player_id"], top, least)


def batter_vs_league(features: DataFrame, players: DataFrame, as_of: str, top: int = TOP, least: float = LEAST_Z) -> DataFrame:
    """Batters' seasons (``since``) against the league's (``before``), which they are part of."""
    season = features.where(_season(as_of))
    league = season.agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"before_{c}") for c in SUMS]).where("_n > 0")
    own = season.join(players.select("player_id").distinct(), "player_id", "left_semi").groupBy("player_id").agg(*[F.sum(c).alias(f"since_{c}") for c in SUMS])
    found = compared(own.join(F.broadcast(league)), ["player_id"]).where(F.col("metric").isin(*VS_LEAGUE))  # the league is one row
    return clearest(found.withColumn("vs", F.lit("league")), ["player_id"], top, least)


def pitcher_change(features: DataFrame, splits: DataFrame, as_of: str, top: int = TOP, least: float = LEAST_Z) -> DataFrame:
    """What changed in pitchers' results since their split, and what their new pitch does that their others don't.

    ``splits`` has player_id, since and pitch_type, which is null where there is no new pitch; ``features`` is
    feature_pitch_daily. The key of a result is the player and the pitch type.
    """
    rows = features.where(_season(as_of)).withColumnRenamed("pitch_type", "_type").join(splits, "player_id")
    late, own = F.col("dt") >= F.col("since"), F.col("_type").eqNullSafe(F.col("pitch_type"))
    keys = ["player_id", "pitch_type"]
    overall = compared(rows.groupBy(*keys).agg(*sides(late, ~late)), keys).where(F.col("metric").isin(*OF_PITCHER))
    overall = overall.select(*keys, "nth", "metric", F.concat("label", F.lit(" (batters against him)")).alias("label"), "since", "before", "n_since", "n_before", "z", _none().alias("vs"))
    mine = compared(rows.where(late & F.col("pitch_type").isNotNull()).groupBy(*keys).agg(*sides(own, ~own)), keys).where(F.col("metric").isin(*OF_PITCH))
    mine = mine.select(*keys, (100 + F.col("nth")).alias("nth"), F.concat(F.lit("new_pitch_"), "metric").alias("metric"), F.concat("label", F.lit(" on his "), "pitch_type", F.lit(", vs his other pitches since")).alias("label"), "since", "before", "n_since", "n_before", "z", F.lit("his other pitches").alias("vs"))
    return clearest(overall.unionByName(mine), keys, top, least)


DRIVER = "array<struct<metric:string,label:string,since:double,before:double,n_since:bigint,n_before:bigint,z:double,vs:string>>"


def attached(candidates: DataFrame, batters: DataFrame, pitchers: DataFrame, as_of: str) -> DataFrame:
    """``candidates`` with ``drivers`` in facts_json, for detectors of single major-league players; others stay as they are.

    Each kind of driver is found for all candidates in one plan.
    """
    mlb = candidates.where((F.col("subject_type") == "player") & (F.col("league_code") == "MLB"))
    fact = lambda name: F.get_json_object("facts_json", f"$.{name}")
    player = F.col("subject_id").alias("player_id")
    recent = mlb.where("detector = 'change_vs_baseline'").select(player, F.date_sub(F.to_date(F.lit(as_of)), fact("recent_days").cast("int") - 1).cast("string").alias("since")).distinct()
    lucky = mlb.where("detector = 'luck_gap'").select(player).distinct()
    pitch = mlb.where("detector in ('new_pitch', 'velocity_change')").select(player, fact("since").alias("since"), F.when(F.col("detector") == "new_pitch", fact("pitch_type")).alias("pitch_type")).distinct()
    none = F.lit(None).cast("string").alias("pitch_type")
    found = batter_change(batters, recent, as_of).withColumns({"detector": F.lit("change_vs_baseline")}).select("*", none)
    found = found.unionByName(batter_vs_league(batters, lucky, as_of).withColumn("detector", F.lit("luck_gap")).select("*", none))
    found = found.unionByName(pitcher_change(pitchers, pitch, as_of).withColumn("detector", F.when(F.col("pitch_type").isNull(), "velocity_change").otherwise("new_pitch")))
    entry = F.struct("rank", *[F.col(c) for c in ("metric", "label", "since", "before", "n_since", "n_before", "z", "vs")])
    lists = found.groupBy(F.col("player_id").alias("subject_id"), "detector", F.col("pitch_type").alias("_type")).agg(F.array_sort(F.collect_list(entry)).alias("_found"))
    lists = lists.withColumn("_found", F.transform("_found", lambda d: d.dropFields("rank")))
    keyed = candidates.withColumn("_type", F.when(F.col("detector") == "new_pitch", fact("pitch_type")))
    same = (keyed["subject_id"] == lists["subject_id"]) & (keyed["detector"] == lists["detector"]) & keyed["_type"].eqNullSafe(lists["_type"])
    joined = keyed.join(lists, same, "left").select(*[keyed[c] for c in candidates.columns], "_found")
    able = (F.col("subject_type") == "player") & (F.col("league_code") == "MLB") & F.col("detector").isin("change_vs_baseline", "luck_gap", "new_pitch", "velocity_change")
    told = F.concat(F.expr("substr(facts_json, 1, length(facts_json) - 1)"), F.when(F.col("facts_json") == "{}", "").otherwise(","), F.lit('"drivers":'), F.to_json(F.coalesce("_found", F.array().cast(DRIVER))), F.lit("}"))
    return joined.withColumn("facts_json", F.when(able, told).otherwise(F.col("facts_json"))).drop("_found")
