"""Pitches as additive components, and the three daily feature tables that are sums of them.

A component is a row of a table: a name, the condition under which a pitch counts, and what it adds then. The tables of
components compile to one projection over fields that are read once from the raw record; every feature table is one
aggregate of that projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from infield.functions import columns as fx

#: Groups of pitch types, and the descriptions that are swings and misses in the feature tables.
GROUPS = {"fastball": ["FF", "SI", "FC", "FA"], "breaking": ["SL", "ST", "CU", "KC", "SV", "CS"], "offspeed": ["CH", "FS", "FO", "SC"]}
FEATURE_SWINGS = ["swinging_strike", "swinging_strike_blocked", "foul", "foul_tip", "foul_bunt", "hit_into_play", "missed_bunt", "bunt_foul_tip"]
#: What the raw record is asked for.
NUMBERS = ["zone", "woba_denom", "woba_value", "estimated_woba_using_speedangle", "launch_speed", "launch_angle", "launch_speed_angle", "hc_x", "hc_y", "release_speed", "release_spin_rate", "babip_value"]
TEXTS = ["description", "pitch_type", "bb_type", "stand", "events"]


@dataclass(frozen=True)
class Component:
    """Adds ``value`` for pitches that meet ``when``, both SQL over the fields of fields(); 0 for others and for null."""

    name: str
    when: str
    value: str = "1"
    number: bool = False  #: a sum of measurements, to six places, and not a count

    def column(self) -> Column:
        zero = F.lit(0.0) if self.number else F.lit(0)
        added = F.expr(self.value).cast("double" if self.number else "int")
        return F.coalesce(F.when(F.expr(self.when), added), zero)


#: The published names of the 24 components that both pitch tables have, in their order.
COMPONENTS = (
    Component("pitches", "true"),
    Component("swings", "swing"),
    Component("whiffs", "whiff"),
    Component("zone_pitches", "in_zone"),
    Component("zone_swings", "in_zone and swing"),
    Component("zone_whiffs", "in_zone and whiff"),
    Component("chase_pitches", "out_zone"),
    Component("chase_swings", "out_zone and swing"),
    Component("bip", "in_play"),
    Component("hard_hit", "in_play and launch_speed >= 95"),
    Component("barrels", "in_play and launch_speed_angle = 6"),
    Component("ev_sum", "in_play", "launch_speed", number=True),
    Component("ev_n", "in_play and launch_speed is not null"),
    Component("la_sum", "in_play", "launch_angle", number=True),
    Component("la_n", "in_play and launch_angle is not null"),
    Component("gb", "bb_type = 'ground_ball'"),
    Component("ld", "bb_type = 'line_drive'"),
    Component("fb", "bb_type = 'fly_ball'"),
    Component("pu", "bb_type = 'popup'"),
    Component("pulled", "pull_side"),
    Component("pulled_air", "pull_side and bb_type in ('line_drive', 'fly_ball')"),
    Component("woba_value", "counted", "woba_value", number=True),
    Component("xwoba_value", "counted", "coalesce(estimated_woba_using_speedangle, woba_value)", number=True),
    Component("woba_den", "counted", "woba_denom"),
)
#: What pitchers' rows have besides, and batters' rows of contact.
SPEED = (
    Component("velo_sum", "true", "release_speed", number=True),
    Component("velo_n", "release_speed is not null"),
    Component("spin_sum", "true", "release_spin_rate", number=True),
    Component("spin_n", "release_spin_rate is not null"),
)
CONTACT = (
    Component("xwoba_bip_n", "in_play and estimated_woba_using_speedangle is not null"),
    Component("balls_in_park", "in_play and events <> 'home_run'"),
    Component("babip_hits", "in_play and events <> 'home_run' and babip_value > 0"),
)


def fields(pitches: DataFrame) -> DataFrame:
    """``pitches`` with a struct ``f`` of what components are made of; a raw record that can't be read has nothing.

    The pitch's own description, pitch type, events and release speed go before those of the raw record; '' is none.
    A ball is in play if the description says so or it has a batted-ball type. The pull side is left field for right-handed
    batters, which is what a record without a stand counts as, and right field for all others.
    """
    raw = F.from_json("raw_json", ", ".join(f"{c} string" for c in [*NUMBERS, *TEXTS]))
    rows = pitches.select("*", F.explode(F.array(raw)).alias("r"))  # a row each: what follows can't be pushed below, which would parse twice
    own = lambda c: F.col(c).cast("string") if c in pitches.columns else F.lit(None).cast("string")
    number = {c: F.col(f"r.{c}").try_cast("double") for c in NUMBERS}
    if "release_speed" in pitches.columns:
        number["release_speed"] = F.when(F.col("release_speed").isNotNull(), F.col("release_speed").try_cast("double")).otherwise(number["release_speed"])
    text = {c: F.coalesce(F.nullif(own(c), F.lit("")) if c in ("description", "pitch_type", "events") else F.lit(None).cast("string"), F.col(f"r.{c}"), F.lit("")) for c in TEXTS}
    # exploding once more keeps the casts from being repeated in every component
    rows = rows.select("*", F.explode(F.array(F.struct(*[v.alias(k) for k, v in (number | text).items()]))).alias("f")).drop("r")
    f = lambda c: F.col(f"f.{c}")
    in_play = (f("description") == "hit_into_play") | (f("bb_type") != "")
    angle = F.degrees(F.atan2(f("hc_x") - 125.42, 198.27 - f("hc_y")))
    right_handed = f("stand").isin("", "R")
    told = {
        "swing": f("description").isin(*FEATURE_SWINGS), "whiff": f("description").isin(*fx.WHIFFS), "in_zone": f("zone").between(1, 9), "out_zone": f("zone") >= 11,
        "in_play": in_play, "pull_side": in_play & F.when(right_handed, angle < -15).otherwise(angle > 15), "counted": f("woba_denom") != 0,
    }
    return rows.select(*[c for c in rows.columns if c != "f"], F.explode(F.array(F.struct("f.*", *[v.alias(k) for k, v in told.items()]))).alias("f"))


def pitch_components(pitches: DataFrame, components: Sequence[Component] = (*COMPONENTS, *SPEED, *CONTACT)) -> DataFrame:
    """dt, pitcher_id, batter_id, pitch_type ('' if unknown), pitch_group and every component of each pitch of a known game."""
    known = fields(pitches.where(fx.present("game_pk")) if "game_pk" in pitches.columns else pitches)
    kept = known.select("dt", "pitcher_id", "batter_id", F.col("f.pitch_type").alias("pitch_type"), "f")
    group = fx.first_match([(F.col("pitch_type").isin(*types), g) for g, types in GROUPS.items()], "other")
    flat = kept.select("dt", "pitcher_id", "batter_id", F.col("pitch_type").alias("_type"), group.alias("pitch_group"), "f.*")
    return flat.select("dt", "pitcher_id", "batter_id", F.col("_type").alias("pitch_type"), "pitch_group", *[c.column().alias(c.name) for c in components])


def _sums(components: Sequence[Component]) -> list[Column]:
    return [(F.round(F.sum(c.name), 6) if c.number else F.sum(c.name)).alias(c.name) for c in components]


def feature_tables(components: DataFrame) -> dict[str, DataFrame]:
    """The daily sums by pitcher and pitch type, by batter and pitch group, and of counted contact by batter."""
    told = [F.lit("MLB").alias("league_code"), F.lit("mlb_statcast").alias("source")]
    typed = components.where(F.col("pitch_type") != "")
    contact = [c for c in COMPONENTS if c.name in ("woba_value", "xwoba_value", "woba_den")]
    return {
        "feature_pitch_daily": typed.where(fx.present("pitcher_id")).groupBy("dt", F.col("pitcher_id").alias("player_id"), "pitch_type").agg(*_sums([*COMPONENTS, *SPEED])).select("*", *told),
        "feature_batter_pitch_daily": typed.where(fx.present("batter_id")).groupBy("dt", F.col("batter_id").alias("player_id"), "pitch_group").agg(*_sums(COMPONENTS)).select("*", *told),
        "feature_contact_daily": components.where(fx.present("batter_id") & (F.col("woba_den") != 0)).groupBy("dt", F.col("batter_id").alias("player_id")).agg(*_sums([*contact, *CONTACT])).withColumnRenamed("balls_in_park", "bip").select("*", *told),
    }
