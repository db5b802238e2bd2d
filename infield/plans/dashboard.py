"""Datasets of the dashboard, from gold tables and the semantic layer's metrics.

Totals at several levels come from one scan by grouping sets, with the level of each row named.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from infield.plans import semantic as sem

Tables = Mapping[str, DataFrame]

#: How feeds are called.
FEEDS = {"mlb_statcast": "MLB (Statcast)", "npb_spaia": "NPB"}


def leveled(df: DataFrame, levels: Mapping[str, Sequence[str]], measures: Sequence[Column]) -> DataFrame:
    """``measures`` of each level (name: its columns) in one pass: level, all columns (null where a level has none) and measures."""
    columns = list(dict.fromkeys(c for cs in levels.values() for c in cs))
    bits = lambda cs: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in cs)
    if len({bits(cs) for cs in levels.values()}) < len(levels):
        raise ValueError("two levels have the same columns")
    sums = df.groupingSets([[F.col(c) for c in cs] for cs in levels.values()], *[F.col(c) for c in columns]).agg(F.grouping_id().alias("_g"), *measures)
    name = F.create_map(*[x for n, cs in levels.items() for x in (F.lit(bits(cs)).cast("long"), F.lit(n))])[F.col("_g")]
    return sums.select(name.alias("level"), *[c for c in sums.columns if c != "_g"])


def in_season(df: DataFrame, season: int) -> DataFrame:
    return df.where(F.col("dt").between(f"{season}-01-01", f"{season}-12-31"))


def totals(t: Tables, season: int) -> DataFrame:
    """One row: games, plate appearances, pitches, current players, days loaded and the latest day of a season."""
    games = in_season(t["fact_game"], season).agg(F.count_distinct("game_id").alias("games"), F.count_distinct("dt").alias("days_loaded"), F.max("dt").alias("latest_day"))
    pas = in_season(t["fact_plate_appearance"], season).agg(F.count("*").alias("plate_appearances"))
    pitches = in_season(t["fact_pitch"], season).agg(F.count("*").alias("pitches"))
    players = sem.v_player_current(t).agg(F.count("*").alias("players"))
    one = games
    for more in (pas, pitches, players):
        one = one.join(F.broadcast(more))  # one row each
    return one.select(F.lit(str(season)).alias("season"), "games", "plate_appearances", "pitches", "players", "days_loaded", "latest_day")


def daily_coverage(pas: DataFrame, season: int) -> DataFrame:
    """Plate appearances by day and feed, by feed, by day and of the season."""
    feed = F.coalesce(F.create_map(*[F.lit(x) for kv in FEEDS.items() for x in kv])[F.col("source")], F.col("source"))
    rows = in_season(pas, season).select(F.to_date("dt").alias("day"), feed.alias("feed"))
    return leveled(rows, {"day and feed": ["day", "feed"], "feed": ["feed"], "day": ["day"], "season": []}, [F.count("*").alias("plate_appearances")])


def quality_results(results: DataFrame, season: int) -> DataFrame:
    """Checks passed, failed and skipped by day, by check, and of the season; ``results`` has dt, check_name and status."""
    rows = in_season(results, season).select(F.to_date("dt").alias("day"), "check_name", "status")
    counts = [F.count_if(F.col("status") == s).alias(n) for s, n in (("pass", "passed"), ("fail", "failed"), ("skip", "skipped"))]
    return leveled(rows, {"check and day": ["day", "check_name"], "check": ["check_name"], "day": ["day"], "season": []}, counts)


def _view(t: Tables) -> Callable[[str], DataFrame]:
    return lambda name: sem.VIEWS[name](t)


def run_expectancy(t: Tables, season: int, league: str = "MLB") -> DataFrame:
    """The season's matrix: a row for each state of the bases, a column for each number of outs."""
    cells = sem.compile_request(sem.MetricRequest(["exp_runs", "re_pa_count"], ["base_state", "runners", "outs"], [("league_code", "eq", league), ("season_year", "eq", season)]), _view(t))
    return cells.groupBy("base_state", "runners").agg(*[F.max(F.when(F.col("outs") == n, F.col("exp_runs"))).alias(f"outs_{n}") for n in range(3)], F.sum("re_pa_count").alias("plate_appearances"))


def run_expectancy_of_season(matrix: DataFrame, season: int, league: str | None = None) -> DataFrame:
    """The published season-to-date matrix as it stood on the season's latest day."""
    rows = matrix.where(F.col("season_year") == season)
    newest = rows.agg(F.max("dt").alias("dt"))
    last = rows.join(F.broadcast(newest), "dt", "left_semi")  # one row
    return last if league is None else last.where(F.col("league_code") == league)


def pitch_mix(t: Tables, season: int, least: int = 50) -> DataFrame:
    """Pitches, mean and highest speed of each pitch type with ``least`` of them."""
    req = sem.MetricRequest(["pitches", "avg_velocity", "max_velocity"], ["pitch_type"], [("pitch_type", "not_null", None), ("season_year", "eq", season)], groups=[("pitches", "gte", least)], names={"pitch_type": "pitch", "avg_velocity": "avg_mph", "max_velocity": "max_mph"})
    return sem.compile_request(req, _view(t))


def hitters(t: Tables, season: int, least: int = 20, most: int = 25) -> DataFrame:
    """The hitters with the most home runs."""
    where = [("league_code", "eq", "MLB"), ("season_year", "eq", season), ("data_source", "eq", "mlb_statcast")]
    names = {"batter_name": "batter", "home_runs": "hr", "walks": "bb", "strikeouts": "k"}
    return sem.compile_request(sem.MetricRequest(["pa", "home_runs", "hits", "walks", "strikeouts", "avg"], ["batter_id", "batter_name"], where, groups=[("pa", "gte", least)], order=[("hr", "desc"), ("pa", "desc"), ("batter_id", "asc")], most=most, names=names), _view(t))


def standings(t: Tables, season: int) -> DataFrame:
    """Records from games of the regular season."""
    where = [("league_code", "eq", "MLB"), ("season_year", "eq", season), ("data_source", "eq", "mlb_statsapi"), ("season_phase", "eq", "regular")]
    names = {"team_name": "team", "wins": "w", "losses": "l", "win_pct": "pct", "run_differential": "run_diff"}
    return sem.compile_request(sem.MetricRequest(["wins", "losses", "win_pct", "run_differential"], ["team_id", "team_name"], where, names=names), _view(t))


def datasets(t: Tables, season: int, results: DataFrame | None = None) -> dict[str, DataFrame]:
    """All that the tables allow, by name."""
    makers: dict[str, tuple[Sequence[str], Callable[[], DataFrame]]] = {
        "totals": (["fact_game", "fact_plate_appearance", "fact_pitch", "dim_player"], lambda: totals(t, season)), "daily_coverage": (["fact_plate_appearance"], lambda: daily_coverage(t["fact_plate_appearance"], season)), "run_expectancy": (["run_expectancy_daily"], lambda: run_expectancy(t, season)),
        "pitch_mix": (["fact_pitch", "fact_plate_appearance", "dim_player", "dim_team"], lambda: pitch_mix(t, season)), "hitters": (["fact_plate_appearance", "run_expectancy_daily", "dim_player"], lambda: hitters(t, season)), "standings": (["fact_game", "dim_team"], lambda: standings(t, season)),
    }
    out = {name: make() for name, (needs, make) in makers.items() if all(n in t for n in needs)}
    if results is not None:
        out["quality"] = quality_results(results, season)
    return out
