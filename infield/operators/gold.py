"""Gold: bridge, dimensions, facts, run expectancy and rolling features, each one job over all days it is given.

Silver tables come as a mapping from (source, entity) to a DataFrame with a ``dt`` column; missing ones count as empty.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from infield.functions import columns as fx
from infield.operators import plays
from infield.operators.relational import dense_running_sums, keep_first, keep_last, rolling_sums

Silver = Mapping[tuple[str, str], DataFrame]

#: Leagues and the months and days of their seasons.
SEASONS = {"MLB": ("03-01", "11-30"), "NPB": ("03-01", "11-30"), "INDY": ("04-01", "10-31"), "KBO": ("03-01", "10-31"), "LMB": ("03-01", "09-30")}
#: Series codes of the Korean feed.
SERIES = {"0": "R", "1": "E", "9": "A", "3": "P", "4": "P", "5": "P", "7": "P"}
GAME_SOURCES = ["mlb_statsapi", "npb_spaia", "indy_local", "kbo_local", "kbo_api", "lmb_local", "retrosheet_local"]
BRIDGE = "entity_type string, source string, source_id string, canonical_id string"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _have(df: DataFrame, name: str, kind: str = "string"):
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


# Identity -----------------------------------------------------------------------------------------------

def match_key(entity: str):
    """(key, confidence, method) of the cascade source id, name and birth date, name and team (or league)."""
    name = F.lower(F.trim("name"))
    by = lambda key, confidence, method: F.struct(key.alias("key"), F.lit(confidence).alias("confidence"), F.lit(method).alias("method"))
    exact = F.when(fx.present("source_id"), by(F.concat(F.lit(f"{entity}:source:"), "source", F.lit(":"), "source_id"), 0.9, "exact_id"))
    if entity == "team":
        return F.coalesce(exact, F.when(fx.present("name") & fx.present("league"), by(F.concat(F.lit("team:name:"), name, F.lit(":"), "league"), 0.7, "name_league")))
    return F.coalesce(
        exact,
        F.when(fx.present("name") & fx.present("dob"), by(F.concat(F.lit("player:name:"), name, F.lit(":"), "dob"), 0.75, "name_dob")),
        F.when(fx.present("name") & fx.present("team"), by(F.concat(F.lit("player:name:"), name, F.lit(":"), "team"), 0.5, "name_team")),
    )


def resolve(records: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """The bridge: one row for each (dt, entity_type, source, source_id) of ``records``, the first in order winning.

    records: entity_type, source, source_id, name, dob, team, league, dt, nth. ``overrides`` (entity_type, source,
    source_id, canonical_id) beat what was matched; both are one job, the overrides a dimension.
    """
    parts = []
    for entity in ("player", "team"):
        mine = records.where(F.col("entity_type") == entity).withColumn("m", match_key(entity)).where("m is not null")
        parts.append(mine)
    rows = keep_first(_union(parts), ["dt", "entity_type", "source", "source_id"], ["nth"])
    manual = F.lit(None).cast("string")
    if overrides is not None:
        given = overrides.where(fx.present("canonical_id")).select("entity_type", "source", "source_id", F.col("canonical_id").alias("_given"))
        rows, manual = rows.join(given, ["entity_type", "source", "source_id"], "left"), F.col("_given")
    out = rows.withColumn("_manual", manual)
    return out.select(
        "entity_type", "source", "source_id", F.coalesce("_manual", fx.canonical_id("m.key")).alias("canonical_id"), F.col("dt").alias("first_seen_dt"), F.col("dt").alias("last_seen_dt"),
        F.when(F.col("_manual").isNotNull(), 1.0).otherwise(F.col("m.confidence")).alias("confidence"), F.when(F.col("_manual").isNotNull(), "manual").otherwise(F.col("m.method")).alias("match_method"), F.col("_manual").isNotNull().alias("manual_override"), "dt",
    )


def merge_events(overrides: DataFrame, days: DataFrame) -> DataFrame:
    """The audit of ids that were merged by hand: each override with an id, on every day of ``days`` (dt) that it was applied to."""
    notes = F.col("notes").cast("string") if "notes" in overrides.columns else F.lit(None).cast("string")
    given = overrides.where(fx.present("canonical_id")).select("entity_type", "source", "source_id", "canonical_id", F.lit("manual_override").alias("match_method"), notes.alias("notes")).distinct()
    return given.crossJoin(days.select("dt").distinct())  # overrides are a short list kept by hand, and days are a range of them


def game_sides(games: DataFrame) -> DataFrame:
    """Home and away teams of games, one row a side."""
    sides = F.array(*[F.struct(F.col(f"{s}_team_id").cast("string").alias("source_id"), F.col(f"{s}_team_name").alias("name")) for s in ("home", "away")])
    return games.select("dt", F.posexplode(sides).alias("side", "t")).select("dt", "side", "t.*").where(fx.present("source_id"))


def collected(silver: Silver) -> DataFrame:
    """Records for resolve(): players of rosters and bios (no staff), Korean names, and both teams of every game.

    ``nth`` puts rosters before bios, and equal ids of one entity in the order of their content, so that which comes first
    does not depend on how rows are dealt.
    """
    parts = []
    order = {"games": 0, "rosters": 0, "player_bios": 1}
    for (source, entity), df in sorted(silver.items(), key=lambda kv: kv[0]):
        at = lambda *content, part=order.get(entity, 2): F.struct(F.lit(part).alias("part"), F.to_json(F.struct(*[F.coalesce(c.cast("string"), F.lit("\uffff")).alias(f"c{i}") for i, c in enumerate(content)])).alias("row")).alias("nth")
        league = F.lit(fx.SOURCE_LEAGUE.get(source))
        if entity == "games":
            sides = game_sides(df)
            parts.append(sides.select(F.lit("team").alias("entity_type"), F.lit(source).alias("source"), "source_id", "name", F.lit(None).cast("string").alias("dob"), F.lit(None).cast("string").alias("team"), league.alias("league"), "dt", at(F.col("name"))))
        elif entity in ("rosters", "player_bios"):
            players = df.where(F.coalesce(_have(df, "role"), F.lit("player")) == "player")
            parts.append(players.select(F.lit("player").alias("entity_type"), F.lit(source).alias("source"), F.col("player_id").cast("string").alias("source_id"), F.col("player_name").alias("name"), _have(df, "dob").alias("dob"), _have(df, "team_id").alias("team"), league.alias("league"), "dt", at(F.col("player_name"), _have(df, "dob"), _have(df, "team_id"))))
        elif source == "kbo_api" and entity.startswith("boxscore"):
            keyed = named_players(df)
            parts.append(keyed.select(F.lit("player").alias("entity_type"), F.lit(source).alias("source"), F.col("player_key").alias("source_id"), F.col("player_name").alias("name"), F.lit(None).cast("string").alias("dob"), F.col("team_id").cast("string").alias("team"), league.alias("league"), "dt", at(F.col("player_name"), F.col("team_id"))))
    return _union(parts)


def named_players(box: DataFrame) -> DataFrame:
    """``box`` with player_key, team and name: a name that a game's team has twice gets ``#2``, in order of its line."""
    stats = sorted(c for c in box.columns if c not in ("dt", "source", "ingested_at_utc"))
    line = F.to_json(F.struct(*stats), {"ignoreNullFields": "false"})
    n = F.row_number().over(Window.partitionBy("dt", "game_id", "team_id", "player_name").orderBy(line))
    key = F.concat(F.col("team_id").cast("string"), F.lit(":"), "player_name", F.when(n == 1, "").otherwise(F.concat(F.lit("#"), n.cast("string"))))
    return box.withColumn("player_key", F.when(fx.present("player_name"), key))


# Dimensions ---------------------------------------------------------------------------------------------

def dim_season(years: DataFrame) -> DataFrame:
    """One row for each league and ``year`` of ``years`` (dt, year)."""
    rows = F.array(*[F.struct(F.lit(code).alias("league_code"), F.lit(a).alias("a"), F.lit(b).alias("b")) for code, (a, b) in SEASONS.items()])
    each = years.select("dt", "year", F.explode(rows).alias("s"))
    year = F.col("year").cast("string")
    return each.select(fx.canonical_id(F.concat_ws(":", F.lit("season"), "s.league_code", year)).alias("season_id"), "s.league_code", F.col("year").alias("season_year"), F.lit("regular").alias("season_type"), F.concat_ws("-", year, "s.a").alias("season_start_dt"), F.concat_ws("-", year, "s.b").alias("season_end_dt"), "dt")


def dim_team_rows(silver: Silver, bridge: DataFrame) -> DataFrame:
    """One row for each team and day, to be merged by scd2: a team list's row (with abbreviation) beats a game's."""
    parts = []
    for source in GAME_SOURCES:
        if (source, "games") in silver:
            sides = plays.with_entity(game_sides(silver[source, "games"]), bridge, "team", source, "source_id", "team_id")
            parts.append(sides.select("team_id", F.lit(fx.SOURCE_LEAGUE[source]).alias("league_code"), F.col("name").alias("team_name"), F.lit(None).cast("string").alias("team_abbrev"), F.lit(None).cast("string").alias("home_city"), F.lit(source).alias("source"), F.col("source_id").alias("source_team_id"), "dt", F.lit(0).alias("_listed")))
    if ("mlb_statsapi", "teams") in silver:
        listed = plays.with_entity(silver["mlb_statsapi", "teams"].withColumnRenamed("team_id", "_id"), bridge, "team", "mlb_statsapi", "_id", "team_id")
        parts.append(listed.select("team_id", F.lit("MLB").alias("league_code"), "team_name", "team_abbrev", "home_city", F.lit("mlb_statsapi").alias("source"), F.col("_id").cast("string").alias("source_team_id"), "dt", F.when(fx.present("team_abbrev"), 1).otherwise(0).alias("_listed")))
    return keep_first(_union(parts).where("team_id is not null"), ["dt", "team_id"], [F.desc("_listed"), "source", "source_team_id", "team_name"]).drop("_listed")


def with_known_attributes(today: DataFrame, previous: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Blank attributes filled from the current rows of the snapshot before."""
    known = previous.where("is_current").select(F.col(key), *[F.col(c).alias("_" + c) for c in columns])
    joined = today.join(known, key, "left")
    return joined.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col("_" + c)) for c in columns}).drop(*["_" + c for c in columns])


def dim_player_rows(silver: Silver, bridge: DataFrame) -> DataFrame:
    """One row for each player and day, the last listed winning: rosters with bios, bios on no roster, Korean names."""
    bio_cols = ["dob", "bats", "throws", "height_cm", "weight_kg", "birth_country"]
    parts = []
    for nth, source in enumerate(["mlb_statsapi", "npb_spaia", "indy_local", "kbo_local", "lmb_local", "retrosheet_local"]):
        if (source, "rosters") not in silver:
            continue
        roster = silver[source, "rosters"]
        rows = roster.where(F.coalesce(_have(roster, "role"), F.lit("player")) == "player") if source == "npb_spaia" else roster
        own = rows.select("dt", F.col("player_id").cast("string").alias("source_player_id"), "player_name", _have(roster, "position").alias("position"), *[_have(roster, c).alias("r_" + c) for c in ("dob", "bats", "throws")], F.get_json_object(_have(roster, "raw_json"), "$.PlayerNameK").alias("kana"))
        if (source, "player_bios") in silver:
            bios = silver[source, "player_bios"]
            bios = bios.select("dt", F.col("player_id").cast("string").alias("source_player_id"), F.col("player_name").alias("bio_name"), *[_have(bios, c, "double" if c.endswith(("cm", "kg")) else "string").alias(c) for c in bio_cols])
            keys = ["dt", "source_player_id"]
            alone = bios.join(own, keys, "left_anti").where(fx.present("bio_name")).withColumn("player_name", F.col("bio_name"))
            own = own.join(bios, keys, "left").unionByName(alone, allowMissingColumns=True).drop("bio_name")
        else:
            own = own.withColumns({c: F.lit(None).cast("double" if c.endswith(("cm", "kg")) else "string") for c in bio_cols})
        own = plays.with_entity(own, bridge, "player", source, "source_player_id", "player_id")
        parts.append(own.withColumns({"source": F.lit(source), "league_code": F.lit(fx.SOURCE_LEAGUE[source]), "_nth": F.lit(nth)}))
    for entity in ("boxscore_batting", "boxscore_pitching"):
        if ("kbo_api", entity) in silver:
            keyed = plays.with_entity(named_players(silver["kbo_api", entity]).where("player_key is not null"), bridge, "player", "kbo_api", "player_key", "_id")
            parts.append(keyed.select("dt", F.col("player_key").alias("source_player_id"), "player_name", F.col("_id").alias("player_id"), F.lit("kbo_api").alias("source"), F.lit("KBO").alias("league_code"), F.lit(3).alias("_nth")))
    rows = keep_last(_union(parts).where("player_id is not null"), ["dt", "player_id"], ["_nth", "source_player_id", "player_name"])
    pick = lambda c: F.coalesce(F.nullif(F.col("r_" + c), F.lit("")), F.nullif(F.col(c), F.lit("")))
    return rows.select(
        "player_id", F.col("player_name").alias("primary_name"), F.when(fx.present("kana"), F.array("kana")).alias("alternate_names"), pick("dob").alias("dob"), F.coalesce(pick("bats"), F.lit("UNK")).alias("bats"), F.coalesce(pick("throws"), F.lit("UNK")).alias("throws"),
        "height_cm", "weight_kg", F.col("birth_country").alias("nationality"), F.col("position").alias("primary_position"), "source", "source_player_id", "league_code", "dt",
    )


# Facts --------------------------------------------------------------------------------------------------

def fact_game(silver: Silver, bridge: DataFrame) -> DataFrame:
    parts = []
    for source in GAME_SOURCES:
        if (source, "games") not in silver:
            continue
        g = silver[source, "games"].withColumnsRenamed({"home_team_id": "_home", "away_team_id": "_away"})
        for side in ("home", "away"):
            g = plays.with_entity(g, bridge, "team", source, "_" + side, f"{side}_team_id")
        league = fx.SOURCE_LEAGUE[source]
        code = fx.first_match([(_have(g, "sr_id") == k, v) for k, v in SERIES.items()], None) if source == "kbo_api" else F.lit(None)
        parts.append(g.select(
            fx.canonical_id(F.concat(F.lit(f"game:{source}:"), F.col("game_id").cast("string"))).alias("game_id"), F.lit(league).alias("league_code"),
            fx.canonical_id(F.concat(F.lit(f"season:{league}:"), F.substring("dt", 1, 4))).alias("season_id"), F.coalesce(F.nullif(_have(g, "game_date"), F.lit("")), F.col("dt")).alias("game_date"), _have(g, "game_date").alias("game_start_ts_utc"),
            "home_team_id", "away_team_id", _have(g, "venue").alias("venue"), F.coalesce(F.nullif(_have(g, "status"), F.lit("")), F.nullif(_have(g, "game_state_name"), F.lit("")), F.lit("unknown")).alias("status"),
            F.coalesce(F.nullif(_have(g, "game_type"), F.lit("")), F.nullif(_have(g, "game_type_name"), F.lit("")), code).alias("game_type"), F.col("home_score").cast("long").alias("home_score"), F.col("away_score").cast("long").alias("away_score"), "dt", F.lit(source).alias("source"), F.col("game_id").cast("string").alias("source_game_id"),
        ))
    return _union(parts)


def fact_roster(silver: Silver, bridge: DataFrame) -> DataFrame:
    parts = []
    for source in ("mlb_statsapi", "npb_spaia", "indy_local", "kbo_local", "lmb_local", "retrosheet_local"):
        if (source, "rosters") in silver:
            r = silver[source, "rosters"]
            r = r.where(F.coalesce(_have(r, "role"), F.lit("player")) == "player") if source == "npb_spaia" else r
            r = r.select("dt", F.col("team_id").alias("_team"), F.col("player_id").alias("_player"))
            r = plays.with_entity(plays.with_entity(r, bridge, "team", source, "_team", "team_id"), bridge, "player", source, "_player", "player_id")
            parts.append(r.select("team_id", "player_id", fx.canonical_id(F.concat(F.lit(f"season:{fx.SOURCE_LEAGUE[source]}:"), F.substring("dt", 1, 4))).alias("season_id"), F.lit("player").alias("role"), F.col("dt").alias("start_dt"), F.lit(None).cast("string").alias("end_dt"), "dt", F.lit(source).alias("source")))
    return _union(parts).dropDuplicates()


def fact_transaction(transactions: DataFrame, bridge: DataFrame) -> DataFrame:
    """Moves of players; repeated rows of a day count once."""
    r = transactions.withColumnsRenamed({"team_id": "_team", "player_id": "_player"})
    r = plays.with_entity(plays.with_entity(r, bridge, "team", "mlb_statsapi", "_team", "team_id"), bridge, "player", "mlb_statsapi", "_player", "player_id")
    return r.select(
        fx.canonical_id(F.concat(F.lit("txn:"), F.col("transaction_id").cast("string"))).alias("transaction_id"), F.lit("MLB").alias("league_code"), "team_id", "player_id", F.col("type_desc").alias("transaction_type"), F.col("date").alias("effective_dt"), F.col("description").alias("details"), "dt", F.lit("mlb_statsapi").alias("source"),
    ).dropDuplicates()


def fact_pitch(pitches: DataFrame, bridge: DataFrame) -> DataFrame:
    p = pitches.withColumnsRenamed({"batter_id": "_b", "pitcher_id": "_p"})
    p = plays.with_entity(plays.with_entity(p, bridge, "player", "mlb_statsapi", "_b", "batter_id"), bridge, "player", "mlb_statsapi", "_p", "pitcher_id")
    pa = F.concat_ws(":", F.col("game_pk").cast("string"), F.col("at_bat_number").cast("string"))
    return p.select(
        fx.canonical_id(F.concat_ws(":", F.lit("pitch:mlb_statcast"), pa, F.col("pitch_number").cast("string"))).alias("pitch_id"), fx.canonical_id(F.concat(F.lit("game:mlb_statsapi:"), F.col("game_pk").cast("string"))).alias("game_id"), fx.canonical_id(F.concat(F.lit("pa:mlb_statcast:"), pa)).alias("pa_id"),
        F.col("pitch_number").cast("long").alias("pitch_number_in_pa"), "pitcher_id", "batter_id", F.col("balls").cast("long").alias("balls_before"), F.col("strikes").cast("long").alias("strikes_before"), "pitch_type", F.col("release_speed").cast("double"), F.col("plate_x").cast("double"), F.col("plate_z").cast("double"), F.col("description").alias("result"), "dt", F.lit("mlb_statcast").alias("source"),
    )


def fact_plate_appearance(silver: Silver, bridge: DataFrame, games: DataFrame) -> DataFrame:
    builders = [("mlb_statcast", "pitches", plays.from_pitches), ("npb_spaia", "game_pbp", plays.from_text), ("retrosheet_local", "game_pbp", plays.from_play_file)]
    rows = _union([make(silver[s, e], bridge) for s, e, make in builders if (s, e) in silver])
    return plays.with_runs_to_end(plays.with_teams(rows, games)).drop("play_order")


def fact_boxscore(silver: Silver, bridge: DataFrame, entity: str) -> DataFrame:
    """Box score lines of all sources, ``entity`` being boxscore_batting or boxscore_pitching.

    Korean players are keyed by name, and only their batting lacks extra bases and walks; local files take ids from
    the bridge alone, others derive missing ones.
    """
    stats = ["ab", "h", "2b", "3b", "hr", "bb", "so", "rbi", "r"] if entity == "boxscore_batting" else ["ip", "h", "r", "er", "bb", "so", "hr"]
    parts = []
    for source in ("mlb_statsapi", "kbo_api", "indy_local", "kbo_local", "lmb_local", "retrosheet_local"):
        if (source, entity) not in silver:
            continue
        b = silver[source, entity]
        b = named_players(b).withColumn("_player", F.col("player_key")) if source == "kbo_api" else b.withColumn("_player", F.col("player_id"))
        b = b.drop("player_id").withColumnRenamed("team_id", "_team")
        b = plays.with_entity(plays.with_entity(b, bridge, "team", source, "_team", "team_id"), bridge, "player", source, "_player", "player_id")
        if source in ("indy_local", "kbo_local", "lmb_local"):
            for kind, column in (("team", "_team"), ("player", "_player")):
                known = bridge.where((F.col("entity_type") == kind) & (F.col("source") == source)).select(F.col("source_id").alias("_sid"))
                found = b.join(known.distinct(), F.col(column).cast("string") == F.col("_sid"), "left")
                b = found.withColumn(f"{kind}_id", F.when(F.col("_sid").isNotNull(), F.col(f"{kind}_id"))).drop("_sid")
        absent = ("2b", "3b", "hr", "bb", "so") if source == "kbo_api" and entity == "boxscore_batting" else ()
        parts.append(b.select(fx.canonical_id(F.concat(F.lit(f"game:{source}:"), F.col("game_id").cast("string"))).alias("game_id"), "team_id", "player_id", *[(F.lit(None).cast("long") if c in absent else _have(b, c, "string" if c == "ip" else "long")).alias(c) for c in stats], "dt", F.lit(source).alias("source")))
    return _union(parts)


def fact_standings(silver: Silver, bridge: DataFrame) -> DataFrame:
    """Standings; integer zeros stay zeros, pct and games behind stay text."""
    s = plays.with_entity(silver["npb_spaia", "standings"].withColumnRenamed("team_id", "_team"), bridge, "team", "npb_spaia", "_team", "team_id")
    return s.select(F.lit("NPB").alias("league_code"), fx.canonical_id(F.concat(F.lit("season:NPB:"), F.substring("dt", 1, 4))).alias("season_id"), "team_id", *[F.col(c).cast("long").alias(c) for c in "wlt"], F.col("pct").cast("string").alias("pct"), F.col("gb").cast("string").alias("gb"), "dt", F.lit("npb_spaia").alias("source"))


# Derived ------------------------------------------------------------------------------------------------

PA_LEAGUE = {"mlb_statcast": "MLB", "retrosheet_local": "MLB", "npb_spaia": "NPB"}


def run_expectancy_daily(pas: DataFrame) -> DataFrame:
    """Count and rest-of-inning runs of each day, league, base state and outs; unknown states and runs don't count."""
    league = fx.first_match([(F.col("source") == s, c) for s, c in PA_LEAGUE.items()], None)
    known = pas.withColumn("league_code", league).where("league_code is not null and runs_to_end_of_inning is not null and base_state_before is not null and outs_before between 0 and 2")
    return known.groupBy("dt", "league_code", F.substring("dt", 1, 4).cast("int").alias("season_year"), F.col("base_state_before").alias("base_state"), F.col("outs_before").alias("outs")).agg(F.count("*").alias("pa_count"), F.sum("runs_to_end_of_inning").alias("runs"))


def run_expectancy(daily: DataFrame, days: DataFrame) -> DataFrame:
    """The season-to-date matrix of every day of ``days`` (dt), days without games included."""
    each = days.select("dt", F.substring("dt", 1, 4).cast("int").alias("season_year")).distinct()
    out = dense_running_sums(daily, each, ["league_code", "base_state", "outs"], "dt", "season_year", ["pa_count", "runs"])
    return out.withColumn("exp_runs", F.round(F.col("runs") / F.col("pa_count"), 4))


def rolling_30d(batting: DataFrame, as_of: str) -> DataFrame:
    sums = rolling_sums(batting, ["player_id"], "dt", ["ab", "h", "hr", "rbi", "bb", "so"], as_of, 30)
    return sums.withColumns({"window_days": F.lit(30), "dt": F.lit(as_of)})
