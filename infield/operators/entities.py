"""Entities of a source as data: how they are fetched, where their records lie in a response, their columns and keys.

A specification compiles to one select: responses are unwrapped to records, records to typed columns, repeated keys to their
first record. Records keep their JSON, so an entity without declared columns passes through whole.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from infield.functions import columns as fx
from infield.operators.relational import keep_first
from infield.operators.silver import arrival

#: How a column's text is read.
KINDS = {"text": lambda c: c, "long": fx.to_long, "double": fx.to_double, "day": lambda c: F.coalesce(fx.iso_date(c), F.col("dt")), "clock": fx.clock}
#: Where lists of records lie in a response.
LISTS = ("data", "stats", "list", "items")


@dataclass(frozen=True)
class Entity:
    name: str
    period: str = "day"  #: a response covers a day, week, month or year
    per: str | None = None  #: fetched once a team, game or player, and batched under that plural
    lists: Sequence[str] = LISTS
    columns: Mapping[str, tuple[Sequence[str], str]] = field(default_factory=dict)  #: name: (fields of the record, the first that is there; kind)
    keys: Sequence[str] = ()  #: of the first record that counts; none: all count

    @property
    def id_column(self) -> str | None:
        return None if self.per is None else f"{self.per}_id"


def _fields(**columns: str) -> dict[str, tuple[Sequence[str], str]]:
    """name="Field,other:kind" for each column."""
    out = {}
    for name, text in columns.items():
        fields, _, kind = text.partition(":")
        out[name] = (fields.split(","), kind or "text")
    return out


#: The entities of the Japanese source, their fields and keys.
NPB = (
    Entity("schedules", lists=("games", *LISTS)),
    Entity("standings", lists=("data", "standings"), columns=_fields(team_id="TeamID,team_id", team_name="TeamName,team_name", w="Win,w:long", l="Lose,l:long", t="Tie,Draw,t:long", pct="WinRate,WinAvg,pct", gb="GameBehind,GameDiff,gb")),
    Entity("game_schedule", lists=("games", *LISTS)),
    Entity("weekly_schedule", "week", lists=("games", *LISTS)),
    Entity("monthly_schedule", "month", lists=("games", *LISTS)),
    Entity("directory", "year", lists=("teams", *LISTS), columns=_fields(team_id="TeamID,team_id,id", player_id="PlayerID,player_id", player_name="PlayerName,player_name")),
    Entity("rosters", "year", "team", ("players", "data", "roster", "list"), _fields(player_id="PlayerID,player_id", player_name="PlayerName,PlayerNameS,player_name"), ("team_id", "player_id")),
    Entity("batter_list", "year", "team"),
    Entity("pitcher_list", "year", "team"),
    Entity("staff_list", "year", "team"),
    Entity("games", lists=("data", "games"), columns=_fields(game_id="GameID,game_id", game_date="GameDate,game_date:day", game_time="GameTime,game_time:clock", home_team_id="HomeTeamID", away_team_id="VisitorTeamID", home_score="HomeScore:long", away_score="VisitorScore:long")),
    Entity("game_pbp", per="game", lists=("data", "events", *LISTS)),
    Entity("game_pitches", per="game"),
    Entity("current_score", per="game"),
    Entity("starting_members", per="game"),
    Entity("game_over_view", per="game"),
    Entity("prediction_game", per="game"),
    Entity("game_batter_stats", per="game"),
    Entity("game_pitcher_stats", per="game"),
    Entity("player_batting_saber", "year", columns=_fields(player_id="PlayerID,player_id")),
    Entity("player_pitching_saber", "year", columns=_fields(player_id="PlayerID,player_id")),
    Entity("player_stats_by_year", "year", "player"),
    Entity("player_stats_by_month", "year", "player"),
    Entity("player_stats_by_game", "year", "player"),
    Entity("player_hitting_career", "year", "player"),
    Entity("player_info", "year", "player"),
    Entity("related_players", "year", "player"),
    Entity("same_draft_year_players", "year", "player"),
)


def _list_in(body: Column, keys: Sequence[str]) -> Column:
    """The objects of a JSON text: of a list, of the first list under one of ``keys``, or the object itself; else none."""
    text = F.trim(body)
    wrapped = [F.from_json(F.when(F.get_json_object(text, f"$.{k}").startswith("["), F.get_json_object(text, f"$.{k}")), "array<string>") for k in keys]
    found = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.coalesce(*wrapped, F.when(text.startswith("{") & F.get_json_object(text, "$").isNotNull(), F.array(text))))
    return F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda r: r.startswith("{"))


def records(entity: Entity, bronze: DataFrame) -> DataFrame:
    """dt, the fan-out's id, nth and raw_json of every record of an entity's responses (dt, body_text).

    A response that isn't JSON has no records. Batched responses lie under ``games``, ``teams`` or ``players``, each with its
    id and its own text.
    """
    rows = bronze.select("dt", arrival(bronze).alias("_at"), "body_text")
    if entity.per is not None:
        holder = F.from_json(F.get_json_object("body_text", f"$.{entity.per}s"), f"array<struct<{entity.id_column}:string,body_text:string>>")
        rows = rows.select("dt", "_at", F.posexplode(holder).alias("_i", "b")).select("dt", F.struct("_at", "_i").alias("_at"), F.col(f"b.{entity.id_column}").alias(entity.id_column), "b.body_text")
    kept = [] if entity.per is None else [entity.id_column]
    return rows.select("dt", *kept, "_at", F.posexplode(_list_in(F.col("body_text"), entity.lists)).alias("_j", "raw_json")).select("dt", *kept, F.struct("_at", "_j").alias("nth"), "raw_json")


def normalised(entity: Entity, bronze: DataFrame) -> DataFrame:
    """The silver table of an entity: its id, typed columns, raw_json and dt; of repeated keys the first record."""
    rows = records(entity, bronze)
    value = lambda names: F.coalesce(*[F.nullif(F.get_json_object("raw_json", f"$.{n}"), F.lit("")) for n in names])
    typed = rows.withColumns({name: KINDS[kind](value(names)) for name, (names, kind) in entity.columns.items()})
    if entity.keys:
        typed = keep_first(typed, ["dt", *entity.keys], ["nth"])
    return typed.drop("nth")


def by_name(entities: Sequence[Entity], name: str) -> Entity:
    for e in entities:
        if e.name == name:
            return e
    raise KeyError(f"no entity {name!r}")


def periods_of(entity: Entity, days: DataFrame) -> DataFrame:
    """The first day of every period of ``days`` (dt) for which an entity is fetched."""
    if entity.period == "day":
        return days.select("dt").distinct()
    return days.select(F.trunc(F.to_date("dt"), entity.period).cast("string").alias("dt")).distinct()


def fan_out(entity: Entity, source: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The work list of a fan-out: each id that the records (dt, raw_json) of a directory or schedule name, once a day."""
    if entity.id_column is None:
        raise ValueError(f"{entity.name} isn't fetched by id")
    value = F.coalesce(*[F.nullif(F.get_json_object("raw_json", f"$.{n}"), F.lit("")) for n in fields])
    return source.select("dt", value.alias(entity.id_column)).where(F.col(entity.id_column).isNotNull()).distinct()


# Stages -------------------------------------------------------------------------------------------------

#: Which entities of which source a stage fetches, and for which league.
STAGES: dict[str, tuple[tuple[str, str, str], ...]] = {
    "schedules": (("mlb", "mlb_statsapi", "schedule"), ("npb", "npb_spaia", "schedules")),
    "rosters": (("mlb", "mlb_statsapi", "rosters"), ("mlb", "mlb_statsapi", "teams"), ("npb", "npb_spaia", "rosters"), ("kbo", "kbo_local", "rosters"), ("lmb", "lmb_local", "rosters")),
    "player_bios": (("mlb", "mlb_statsapi", "player_bios"),),
    "transactions": (("mlb", "mlb_statsapi", "transactions"),),
    "games": (
        ("mlb", "mlb_statsapi", "schedule"), ("npb", "npb_spaia", "games"), ("retrosheet", "retrosheet_local", "gameinfo"), ("kbo", "kbo_local", "games"), ("kbo", "kbo_local", "boxscore_batting"), ("kbo", "kbo_local", "boxscore_pitching"), ("kbo", "kbo_api", "games"),
        ("lmb", "lmb_local", "games"), ("lmb", "lmb_local", "boxscore_batting"), ("lmb", "lmb_local", "boxscore_pitching"),
    ),
    "pbp": (("npb", "npb_spaia", "game_pbp"), ("retrosheet", "retrosheet_local", "plays")),
    "pitches": (("mlb", "mlb_statcast", "pitches"), ("npb", "npb_spaia", "game_pitches")),
    "boxscores": (("mlb", "mlb_statsapi", "boxscore"), ("kbo", "kbo_api", "boxscore")),
    "npb_stats": tuple(("npb", "npb_spaia", e) for e in ("standings", "player_batting_saber", "player_pitching_saber", "player_stats_by_year", "player_stats_by_month", "player_stats_by_game", "player_hitting_career", "game_batter_stats", "game_pitcher_stats")),
}


def planned(stages: Sequence[str] = tuple(STAGES), leagues: Collection[str] | None = None) -> list[tuple[str, str, str]]:
    """(stage, source, entity) of the leagues asked for, all by default, in order and once each; historic files go with MLB."""
    unknown = [s for s in stages if s not in STAGES]
    if unknown:
        raise KeyError(f"no stages {unknown}")
    wanted = None if leagues is None else {x.lower() for x in leagues}
    allowed = lambda league: wanted is None or league in wanted or (league == "retrosheet" and "mlb" in wanted)
    return list(dict.fromkeys((stage, source, entity) for stage in stages for league, source, entity in STAGES[stage] if allowed(league)))


def unlisted(season_list: DataFrame, rosters: DataFrame, key: str = "player_id") -> DataFrame:
    """Players of a day's season list who are on none of the day's rosters, once each (the first by content)."""
    rest = season_list.where(fx.present(key)).join(rosters.where(fx.present(key)).select("dt", F.col(key)).distinct(), ["dt", key], "left_anti")
    order = F.to_json(F.struct(*sorted(c for c in rest.columns if c not in ("dt", key))), {"ignoreNullFields": "false"})
    w = Window.partitionBy("dt", key).orderBy(order)
    return rest.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
