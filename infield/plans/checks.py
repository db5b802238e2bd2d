"""Checks of a lakehouse declared as data and compiled: one aggregate a table measures every day, checks are columns over days.

A measure is an SQL aggregate over one table's rows of a day. All measures of a table share one scan and one shuffle of its
days; the tables' days meet in one row a day. A day check is an expression over the measures of a day, whatever tables they
come from, so comparing tables needs no join of their rows; a range check is an aggregate over the days.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HARD, SOFT = "hard", "soft"


@dataclass(frozen=True)
class Measure:
    """``value`` over the rows of ``table`` that meet ``where``; ``empty`` for a day on which the table has no rows."""

    name: str
    table: str
    value: str = "count(*)"
    where: str = "true"
    empty: str = "0"


@dataclass(frozen=True)
class Check:
    """Passes where ``passes`` holds; skipped where ``applies`` doesn't. ``value`` is what is reported."""

    name: str
    value: str
    passes: str
    applies: str = "true"
    severity: str = HARD
    whole: bool = False  #: aggregates over all days, and not measures of one


def repeats(*keys: str, where: str = "true") -> str:
    """The aggregate of rows beyond the first of each key; null parts of a key count as equal, rows without its first part don't count."""
    known = f"{keys[0]} is not null and ({where})"
    return f"count_if({known}) - count(distinct case when {known} then struct({', '.join(keys)}) end)"


def _aggregate(m: Measure) -> Column:
    return F.expr(m.value if m.where == "true" else f"{m.value} filter (where {m.where})").alias(m.name)


def by_day(tables: Mapping[str, DataFrame], measures: Sequence[Measure], start: str, end: str, days: DataFrame | None = None) -> DataFrame:
    """dt and every measure, a row for each day of the range that any table (or ``days``) has; measures of absent tables are empty."""
    names = [m.name for m in measures]
    if len(set(names)) < len(names):
        raise ValueError("a measure is there twice")
    inside = F.col("dt").between(start, end)
    parts = [] if days is None else [days.where(inside).select("dt").distinct()]
    for name in dict.fromkeys(m.table for m in measures):
        if name in tables:
            own = [m for m in measures if m.table == name]
            parts.append(tables[name].where(inside).groupBy("dt").agg(*[_aggregate(m) for m in own]))
    if not parts:
        raise ValueError("none of the measured tables is there")
    united = parts[0]
    for more in parts[1:]:
        united = united.unionByName(more, allowMissingColumns=True)
    made = set(united.columns)
    wide = united.groupBy("dt").agg(*[F.max(m.name).alias(m.name) for m in measures if m.name in made])
    return wide.select("dt", *[F.coalesce(F.col(m.name) if m.name in made else F.lit(None).cast("double"), F.expr(m.empty)).alias(m.name) for m in measures])


def run(daily: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """dt, check_name, severity, value and status (pass, fail, skip) of every check, of a day or (dt is null) of the range."""
    names = [c.name for c in checks]
    if len(set(names)) < len(names):
        raise ValueError("a check is there twice")

    def told(some: Sequence[Check]) -> Column:
        entry = lambda c: F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.expr(c.value).cast("double").alias("value"), F.when(~F.coalesce(F.expr(c.applies), F.lit(False)), "skip").when(F.coalesce(F.expr(c.passes), F.lit(False)), "pass").otherwise("fail").alias("status"))
        return F.explode(F.array(*[entry(c) for c in some])).alias("c")

    out = []
    if each := [c for c in checks if not c.whole]:
        out.append(daily.select("dt", told(each)).select("dt", "c.*"))
    if whole := [c for c in checks if c.whole]:
        entries = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.expr(c.value).cast("double").alias("value"), F.when(~F.coalesce(F.expr(c.applies), F.lit(False)), "skip").when(F.coalesce(F.expr(c.passes), F.lit(False)), "pass").otherwise("fail").alias("status")) for c in whole]
        flat = daily.agg(*[e.alias(f"c{i}") for i, e in enumerate(entries)])
        out.append(flat.select(F.lit(None).cast("string").alias("dt"), F.explode(F.array(*[F.col(f"c{i}") for i in range(len(entries))])).alias("c")).select("dt", "c.*"))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


#: The measures and checks of the lakehouse. Thresholds of rows, plate appearances and roster sizes.
FINAL = "lower(status) rlike 'final|completed|game over'"
LAKEHOUSE_MEASURES = (
    Measure("games", "fact_game"),
    Measure("mlb_final_games", "fact_game", where=f"source = 'mlb_statsapi' and {FINAL}"),
    Measure("npb_final_games", "fact_game", where=f"source = 'npb_spaia' and {FINAL}"),
    Measure("repeated_games", "fact_game", repeats("game_id")),
    Measure("mlb_pas", "fact_plate_appearance", where="source = 'mlb_statcast' and event_type <> 'TRUNCATED'"),
    Measure("npb_pas", "fact_plate_appearance", where="source = 'npb_spaia' and event_type <> 'TRUNCATED'"),
    Measure("pas", "fact_plate_appearance"),
    Measure("pas_without_team", "fact_plate_appearance", where="batting_team_id is null or fielding_team_id is null"),
    Measure("repeated_pas", "fact_plate_appearance", repeats("pa_id")),
    Measure("repeated_pitches", "fact_pitch", repeats("pitch_id")),
    Measure("batting_lines", "fact_boxscore_batting"),
    Measure("repeated_batting_lines", "fact_boxscore_batting", repeats("game_id", "player_id")),
    Measure("current_players", "dim_player", "count(distinct player_id)", "is_current"),
    Measure("repeated_players", "dim_player", repeats("player_id", where="is_current")),
    Measure("players_without_bats", "dim_player", where="is_current and bats is null"),
    Measure("roster_rows", "fact_roster"),
    Measure("smallest_roster", "fact_roster", "count(*) / nullif(count(distinct team_id), 0)", empty="cast(null as double)"),
    Measure("silver_pitches", "silver_pitches", where="game_pk is not null"),
    Measure("repeated_silver_pitches", "silver_pitches", repeats("game_pk", "at_bat_number", "pitch_number")),
    Measure("silver_box_scores", "silver_boxscore_batting", where="game_id is not null"),
    Measure("silver_games", "silver_games", where="game_id is not null"),
)
LAKEHOUSE_CHECKS = (
    Check("games without plate appearances", "mlb_final_games", "mlb_pas > 0", "mlb_final_games > 0"),
    Check("plate appearances a game", "mlb_pas / nullif(mlb_final_games, 0)", "mlb_pas / nullif(mlb_final_games, 0) between 60 and 110", "mlb_final_games > 0"),
    Check("NPB plate appearances a game", "npb_pas / nullif(npb_final_games, 0)", "npb_pas / nullif(npb_final_games, 0) between 55 and 110", "npb_final_games > 0"),
    Check("plate appearances with teams", "pas_without_team", "pas_without_team = 0", "pas > 0"),
    Check("one row a game", "repeated_games", "repeated_games = 0"),
    Check("one row a plate appearance", "repeated_pas", "repeated_pas = 0"),
    Check("one row a pitch", "repeated_pitches", "repeated_pitches = 0"),
    Check("one batting line a player and game", "repeated_batting_lines", "repeated_batting_lines = 0"),
    Check("one current row a player", "repeated_players", "repeated_players = 0", "current_players > 0"),
    Check("players with a batting side", "1 - players_without_bats / nullif(current_players, 0)", "players_without_bats / nullif(current_players, 0) <= 0.2", "current_players > 0", SOFT),
    Check("players a roster", "smallest_roster", "smallest_roster between 20 and 200", "roster_rows > 0", SOFT),
    Check("silver pitches on days with games", "silver_pitches", "silver_pitches >= 200", "mlb_final_games > 0"),
    Check("one silver row a pitch", "repeated_silver_pitches", "repeated_silver_pitches = 0"),
    Check("box scores without games", "silver_box_scores", "silver_games > 0", "silver_box_scores > 0"),
    Check("days with games", "count_if(games > 0)", "count_if(games > 0) > 0", whole=True),
    Check("gaps of more than a week", "max(unix_date(to_date(dt))) - min(unix_date(to_date(dt))) + 1 - count(*)", "count(*) * 7 >= max(unix_date(to_date(dt))) - min(unix_date(to_date(dt)))", whole=True, severity=SOFT),
)


def season_covered(first: str, last: str, today: str) -> Check:
    """Whether final games reach from a season's first day to its last, or to now."""
    lo, hi = "min(case when mlb_final_games > 0 then dt end)", "max(case when mlb_final_games > 0 then dt end)"
    ended = "true" if today > last else "false"
    return Check("season covered", "count_if(mlb_final_games > 0)", f"{lo} <= '{first}' and (not {ended} or {hi} >= '{last}')", whole=True)


def lakehouse(tables: Mapping[str, DataFrame], start: str, end: str, more: Sequence[Check] = ()) -> DataFrame:
    """All checks of the lakehouse over a range of days; tables that aren't there have empty measures."""
    return run(by_day(tables, LAKEHOUSE_MEASURES, start, end), [*LAKEHOUSE_CHECKS, *more])


def silver_audit(tables: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """table_name, measure and value of each silver table (rows, its key, columns to look at): one scan and aggregate a table.

    Measures are days, rows, repeated (rows beyond the first of a day's key), first_dt and last_dt as days since 1970, and
    null:column, the share without a value, where '', '[]' and '{}' are none.
    """
    out = None
    for name, (df, keys, columns) in tables.items():
        empty = lambda c: F.avg(F.when(F.col(c).isNull() | F.trim(F.col(c).cast("string")).isin("", "[]", "{}"), 1.0).otherwise(0.0))
        day = F.to_date("dt")
        made = {"days": F.count_distinct("dt"), "rows": F.count("*"), "repeated": F.expr(repeats("dt", *keys)), "first_dt": F.unix_date(F.min(day)), "last_dt": F.unix_date(F.max(day))} | {f"null:{c}": empty(c) for c in columns}
        one = df.agg(*[v.cast("double").alias(k) for k, v in made.items()])
        flat = one.select(F.lit(name).alias("table_name"), F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), F.col(f"`{k}`").alias("value")) for k in made])).alias("m")).select("table_name", "m.*")
        out = flat if out is None else out.unionByName(flat)
    return out
