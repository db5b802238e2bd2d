"""Silver: raw feeds flattened to typed rows. Input is bronze, one record a row; nothing is collected.

A bronze row has ``body_text`` (the JSON of the response) and ``dt``. Junk numbers become null, bad JSON gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from infield.functions import columns as fx
from infield.operators.relational import keep_first

GAMES = """struct<dates:array<struct<games:array<struct<gamePk:string,officialDate:string,gameDate:string,gameType:string,status:struct<detailedState:string>,venue:struct<name:string>,
teams:struct<home:struct<score:string,team:struct<id:string,name:string>>,away:struct<score:string,team:struct<id:string,name:string>>>>>>>>"""


def arrival(df: DataFrame) -> Column:
    """What rows came first: file, place in it, order within its split, however Spark packs files into tasks.

    A frame that isn't read right from files has the order of its partitions.
    """
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return F.monotonically_increasing_id()
    return F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("nth"))


def _parsed(bronze: DataFrame, schema: str) -> DataFrame:
    return bronze.select("dt", F.from_json("body_text", schema).alias("j")).where("j is not null")


def mlb_games(bronze: DataFrame) -> DataFrame:
    g = _parsed(bronze, GAMES).select("dt", F.explode_outer("j.dates").alias("d")).select("dt", F.explode_outer("d.games").alias("g")).where("g.gamePk is not null")
    side = lambda s: [F.col(f"g.teams.{s}.team.id").alias(f"{s}_team_id"), F.col(f"g.teams.{s}.team.name").alias(f"{s}_team_name"), fx.to_long(f"g.teams.{s}.score").alias(f"{s}_score")]
    return g.select(F.col("g.gamePk").alias("game_id"), F.coalesce("g.officialDate", F.substring("g.gameDate", 1, 10)).alias("game_date"), *side("home"), *side("away"), F.col("g.venue.name").alias("venue"), F.col("g.status.detailedState").alias("status"), F.col("g.gameType").alias("game_type"), "dt")


def mlb_rosters(bronze: DataFrame) -> DataFrame:
    """Rosters, whose body holds the response as JSON text once more; the first row of a team's player wins."""
    inner = F.coalesce(F.get_json_object("body_text", "$.body_text"), F.col("body_text"))
    r = bronze.select("dt", arrival(bronze).alias("nth"), F.from_json(inner, "struct<teamId:string,roster:array<struct<person:struct<id:string,fullName:string>,position:struct<abbreviation:string>>>>").alias("j"))
    rows = r.select("dt", "nth", F.col("j.teamId").alias("team_id"), F.posexplode("j.roster").alias("at", "p")).select("dt", "nth", "at", "team_id", F.col("p.person.id").alias("player_id"), F.col("p.person.fullName").alias("player_name"), F.col("p.position.abbreviation").alias("position")).where("player_id is not null")
    return keep_first(rows, ["dt", "team_id", "player_id"], ["nth", "at"]).drop("nth", "at")


def mlb_transactions(bronze: DataFrame) -> DataFrame:
    t = _parsed(bronze, "struct<transactions:array<struct<id:string,typeDesc:string,date:string,description:string,person:struct<id:string>,toTeam:struct<id:string>,team:struct<id:string>>>>").select("dt", F.explode("j.transactions").alias("t"))
    return t.select(F.col("t.id").alias("transaction_id"), F.coalesce("t.toTeam.id", "t.team.id").alias("team_id"), F.col("t.person.id").alias("player_id"), F.col("t.typeDesc").alias("type_desc"), F.col("t.date").alias("date"), F.col("t.description").alias("description"), "dt")


def height_cm(text: Column) -> Column:
    """6' 2" in centimetres, to a tenth."""
    part = lambda i: F.nullif(F.regexp_extract(text, r"^\s*(\d+)'\s*(\d+)", i), F.lit("")).try_cast("int")
    return F.round((part(1) * 12 + part(2)) * F.lit(2.54), 1)


def weight_kg(pounds: Column) -> Column:
    return F.round(fx.to_double(pounds) * 0.45359237, 1)


def mlb_bios(bronze: DataFrame) -> DataFrame:
    p = _parsed(bronze, "struct<people:array<struct<id:string,fullName:string,birthDate:string,birthCountry:string,height:string,weight:string,batSide:struct<code:string>,pitchHand:struct<code:string>>>>").select("dt", F.explode("j.people").alias("p"))
    return p.select(F.col("p.id").alias("player_id"), F.col("p.fullName").alias("player_name"), F.col("p.birthDate").alias("dob"), F.col("p.batSide.code").alias("bats"), F.col("p.pitchHand.code").alias("throws"), F.col("p.birthCountry").alias("birth_country"), height_cm(F.col("p.height")).alias("height_cm"), weight_kg(F.col("p.weight")).alias("weight_kg"), "dt")


def mlb_teams(bronze: DataFrame) -> DataFrame:
    t = _parsed(bronze, "struct<teams:array<struct<id:string,name:string,abbreviation:string,locationName:string>>>").select("dt", F.explode("j.teams").alias("t")).where("t.id is not null")
    return t.select(F.col("t.id").alias("team_id"), F.col("t.name").alias("team_name"), F.col("t.abbreviation").alias("team_abbrev"), F.col("t.locationName").alias("home_city"), "dt")


def mlb_boxscore(bronze: DataFrame, kind: str) -> DataFrame:
    """Box score lines, ``kind`` batting or pitching: the values of a map of players; without at-bats and appearances, or innings, no line."""
    line = "batting:struct<atBats:string,plateAppearances:string,hits:string,doubles:string,triples:string,homeRuns:string,baseOnBalls:string,strikeOuts:string,rbi:string,runs:string>,pitching:struct<inningsPitched:string,hits:string,runs:string,earnedRuns:string,baseOnBalls:string,strikeOuts:string,homeRuns:string>"
    side = f"struct<team:struct<id:string>,players:map<string,struct<person:struct<id:string>,stats:struct<{line}>>>>"
    b = _parsed(bronze, f"struct<gamePk:string,teams:struct<home:{side},away:{side}>>").select("dt", F.col("j.gamePk").alias("game_id"), F.explode(F.array("j.teams.home", "j.teams.away")).alias("s"))
    p = b.select("dt", "game_id", F.col("s.team.id").alias("team_id"), F.explode(F.map_values("s.players")).alias("p")).select("dt", "game_id", "team_id", F.col("p.person.id").alias("player_id"), F.col(f"p.stats.{kind}").alias("x"))
    n = lambda f, name: fx.to_long(f"x.{f}").alias(name)
    if kind == "batting":
        played = (F.coalesce(fx.to_long("x.atBats"), F.lit(0)) > 0) | (F.coalesce(fx.to_long("x.plateAppearances"), F.lit(0)) > 0)
        return p.where(played).select("game_id", "team_id", "player_id", n("atBats", "ab"), n("hits", "h"), n("doubles", "2b"), n("triples", "3b"), n("homeRuns", "hr"), n("baseOnBalls", "bb"), n("strikeOuts", "so"), n("rbi", "rbi"), n("runs", "r"), "dt")
    return p.where(fx.present("x.inningsPitched")).select("game_id", "team_id", "player_id", F.col("x.inningsPitched").alias("ip"), n("hits", "h"), n("runs", "r"), n("earnedRuns", "er"), n("baseOnBalls", "bb"), n("strikeOuts", "so"), n("homeRuns", "hr"), "dt")


PITCH_NUMBERS = {"at_bat_number": "long", "pitch_number": "long", "inning": "long", "outs_when_up": "long", "balls": "long", "strikes": "long", "release_speed": "double", "plate_x": "double", "plate_z": "double"}


def pitches(rows: DataFrame) -> DataFrame:
    """Tracked pitches from CSV rows: cast, without those that lack a game, the first of each game, at-bat and number."""
    rows = rows.withColumn("_nth", arrival(rows))
    typed = rows.withColumns({c: fx.to_long(c) if t == "long" else fx.to_double(c) for c, t in PITCH_NUMBERS.items() if c in rows.columns}).where(fx.present("game_pk"))
    return keep_first(typed, ["game_pk", "at_bat_number", "pitch_number"], ["_nth"]).drop("_nth")


def pitch_repeats(rows: DataFrame) -> DataFrame:
    """Repeated pitches: how many repeat exactly and how many differ."""
    from infield.operators.relational import duplicate_kinds

    return duplicate_kinds(rows, ["game_pk", "at_bat_number", "pitch_number"])


def records(bronze: DataFrame, keys: tuple[str, ...] = ("data",)) -> DataFrame:
    """One row for each record of a response: a list, a list under one of ``keys``, or else a single object."""
    list_of = "array<string>"
    wrapped = [F.from_json(F.get_json_object("body_text", f"$.{k}"), list_of) for k in keys]
    body = F.trim("body_text")
    whole = F.when(body.startswith("["), F.from_json("body_text", list_of)).otherwise(F.coalesce(*wrapped, F.when(body.startswith("{"), F.array("body_text"))))
    return bronze.select("dt", F.posexplode(whole).alias("nth", "raw_json"))


def _json(*names: str) -> Column:
    return F.coalesce(*[F.nullif(F.get_json_object("raw_json", f"$.{n}"), F.lit("")) for n in names])


def npb_games(rows: DataFrame) -> DataFrame:
    return rows.select(_json("GameID", "game_id").alias("game_id"), F.coalesce(fx.iso_date(_json("GameDate", "game_date")), F.col("dt")).alias("game_date"), fx.clock(_json("GameTime", "game_time")).alias("game_time"), _json("HomeTeamID").alias("home_team_id"), _json("HomeTeamName", "HomeTeamNameS").alias("home_team_name"), _json("VisitorTeamID").alias("away_team_id"), _json("VisitorTeamName", "VisitorTeamNameS").alias("away_team_name"), _json("GameStateName").alias("game_state_name"), _json("GameTypeName").alias("game_type_name"), fx.to_long(_json("HomeScore")).alias("home_score"), fx.to_long(_json("VisitorScore")).alias("away_score"), "dt")


#: Kinds of staff and position names of the Japanese directory.
STAFF = {"1": "manager", "2": "manager", "3": "coach", "4": "player", "5": "player", "7": "staff", "10": "staff"}
POSITIONS = {"投手": "P", "捕手": "C", "内野手": "IF", "外野手": "OF"}


def npb_rosters(rows: DataFrame) -> DataFrame:
    kind = _json("StaffKind", "staff_kind")
    r = rows.select(_json("TeamID", "team_id").alias("team_id"), _json("PlayerID", "player_id").alias("player_id"), _json("PlayerName", "PlayerNameS", "player_name").alias("player_name"), fx.first_match([(_json("RosterName", "position") == k, v) for k, v in POSITIONS.items()], None).alias("position"), F.when(kind.isNotNull(), fx.first_match([(kind == k, v) for k, v in STAFF.items()], "staff")).alias("role"), "raw_json", "dt", "nth")
    return keep_first(r, ["dt", "team_id", F.coalesce("player_id", "raw_json")], ["nth"]).drop("nth")


def npb_plays(rows: DataFrame) -> DataFrame:
    return rows.select(_json("GameID", "game_id").alias("game_id"), fx.to_long(_json("Inning", "inning")).alias("inning"), _json("TB", "top_bottom").alias("top_bottom"), fx.to_long(_json("AtBat", "play_ab")).alias("play_ab"), fx.to_long(_json("SeqNo", "play_seq_no")).alias("play_seq_no"), _json("EventID", "event_id").alias("event_id"), _json("PlayerID", "play_player_id").alias("play_player_id"), _json("TextInfo_Text", "text_info_text").alias("text_info_text"), F.col("raw_json").alias("raw_event_json"), "dt")


def npb_standings(rows: DataFrame) -> DataFrame:
    """Standings; a zero is a zero, pct and games behind are text."""
    return rows.select(_json("TeamID", "team_id").alias("team_id"), fx.to_long(_json("Win", "w")).alias("w"), fx.to_long(_json("Lose", "l")).alias("l"), fx.to_long(_json("Tie", "Draw", "t")).alias("t"), _json("WinRate", "WinAvg", "pct").alias("pct"), _json("GameBehind", "GameDiff", "gb").alias("gb"), "dt")


def kbo_games(rows: DataFrame) -> DataFrame:
    state, cancelled = _json("GAME_STATE_SC", "state"), _json("CANCEL_SC_NM", "cancel_name")
    status = F.when(cancelled.isNotNull() & (cancelled != "정상경기"), cancelled).otherwise(fx.first_match([(state == "1", "Scheduled"), (state == "2", "In Progress"), (state == "3", "Final")], None))
    date = _json("G_DT", "game_date")
    return rows.select(_json("G_ID", "game_id").alias("game_id"), F.coalesce(fx.iso_date(date), date).alias("game_date"), _json("HOME_ID").alias("home_team_id"), _json("HOME_NM").alias("home_team_name"), _json("AWAY_ID").alias("away_team_id"), _json("AWAY_NM").alias("away_team_name"), status.alias("status"), _json("SR_ID").alias("sr_id"), fx.to_long(_json("B_SCORE_CN")).alias("home_score"), fx.to_long(_json("T_SCORE_CN")).alias("away_score"), "dt")


def grid(rows: DataFrame, column: str) -> DataFrame:
    """A table of cells as JSON text, to one row for each of its rows: nth and cells."""
    return rows.withColumn("_g", F.from_json(column, "array<array<string>>")).select(*[c for c in rows.columns if c != column], F.posexplode("_g").alias("nth", "cells"))


def zipped_rows(rows: DataFrame, left: str, right: str) -> DataFrame:
    """Two parallel arrays joined by position; the longer one's rest has nulls on the other side."""
    return rows.withColumn("_z", F.arrays_zip(left, right)).select(*[c for c in rows.columns if c not in (left, right)], F.posexplode("_z").alias("nth", "z")).select("*", F.col(f"z.{left}").alias(left), F.col(f"z.{right}").alias(right)).drop("z")


def kbo_batting(rows: DataFrame) -> DataFrame:
    """rows (game_id, team_id, names: array of cells, lines: array of AB, R, H, RBI cells, dt); batters without a name, four cells or at-bats are no rows."""
    z = zipped_rows(rows, "names", "lines")
    at = lambda i, name: fx.to_long(F.get("lines", F.lit(i))).alias(name)
    return z.select("game_id", "team_id", F.element_at("names", -1).alias("player_name"), at(0, "ab"), at(1, "r"), at(2, "h"), at(3, "rbi"), F.size("lines").alias("_cells"), "dt").where(fx.present("player_name") & (F.col("_cells") >= 4) & (F.col("ab") > 0)).drop("_cells")


def by_header(rows: DataFrame, header: str, cells: str, wanted: dict[str, str]) -> DataFrame:
    """Cells looked up by their header's text, not their place; the last of equal headers counts, a missing cell is null."""
    zipped = F.arrays_zip(F.col(header).alias("h"), F.col(cells).alias("c"))
    cell = lambda text: F.try_element_at(F.filter("_z", lambda z: F.trim(z["h"]) == text), F.lit(-1))["c"]
    return rows.withColumn("_z", zipped).withColumns({name: cell(text) for name, text in wanted.items()}).drop("_z", header, cells)


def retrosheet(rows: DataFrame, renamed: dict[str, str], numbers: list[str]) -> DataFrame:
    """A projection of CSV rows: renamed columns, numbers cast, blank text null."""
    return rows.select(*[(fx.to_long(a) if b in numbers else fx.to_text(a)).alias(b) for a, b in renamed.items()], "dt")


#: Game types of play files.
GAME_TYPES = {"regular": "R", "playoff": "R", "worldseries": "W", "lcs": "L", "divisionseries": "D", "wildcard": "F", "allstar": "A", "exhibition": "E", "championship": "P"}


def retrosheet_game_type(c: Column | str) -> Column:
    c = F.lower(F.col(c) if isinstance(c, str) else c)
    return fx.first_match([(c == k, v) for k, v in GAME_TYPES.items()], None)


def without_meta(rows: DataFrame) -> DataFrame:
    """Local files that come as tables: all columns but the ones that ingestion adds."""
    return rows.drop("source")


#: What makes a silver table, by source and entity.
NORMALISERS: dict[tuple[str, str], Callable[[DataFrame], DataFrame]] = {
    ("mlb_statsapi", "games"): mlb_games, ("mlb_statsapi", "rosters"): mlb_rosters, ("mlb_statsapi", "transactions"): mlb_transactions, ("mlb_statsapi", "player_bios"): mlb_bios, ("mlb_statsapi", "teams"): mlb_teams,
    ("mlb_statsapi", "boxscore_batting"): lambda b: mlb_boxscore(b, "batting"), ("mlb_statsapi", "boxscore_pitching"): lambda b: mlb_boxscore(b, "pitching"), ("mlb_statcast", "pitches"): pitches,
    ("npb_spaia", "games"): lambda b: npb_games(records(b, ("data", "games"))), ("npb_spaia", "rosters"): lambda b: npb_rosters(records(b, ("data", "rosters"))), ("npb_spaia", "game_pbp"): lambda b: npb_plays(records(b, ("data", "events"))), ("npb_spaia", "standings"): lambda b: npb_standings(records(b, ("data", "standings"))),
    ("kbo_api", "games"): lambda b: kbo_games(records(b, ("game", "data"))), **{(s, e): without_meta for s in ("kbo_local", "indy_local", "lmb_local") for e in ("games", "rosters", "boxscore_batting", "boxscore_pitching")},
}


def normalise(source: str, entity: str, bronze: DataFrame) -> DataFrame:
    if (source, entity) not in NORMALISERS:
        raise KeyError(f"no silver table {entity!r} of {source!r}")
    return NORMALISERS[source, entity](bronze)


def input_order(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn("_nth", arrival(df)).withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("_nth"))).drop("_nth")
