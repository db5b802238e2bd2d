"""Queries of views, metrics and dashboard datasets on gold tables that are derived from the driver's tables.

``events`` become plate appearances, ``lineitem`` pitches and box score lines, ``orders`` games, ``customer`` players with
two snapshots, ``nation`` teams; the same tables in DuckDB's SQL are the beginning of every statement.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from infield.operators import entities as en
from infield.operators import gold, plays
from infield.plans import dashboard as db
from infield.plans import semantic as sem
from infield.registry import events, id_sql, query, t
from infield.sources import lake

_CODES = ["1B", "2B", "3B", "HR", "BB", "HBP", "K", "OUT", "SF", "SH", "TRUNCATED", "DP"]
_TYPES = ["R", "W", "A", "S"]
_STATES = ["Final", "Final: Tied", "Postponed", "Game Over", "Completed Early: Rain"]
_WHAT = ["swinging_strike", "foul", "ball", "hit_into_play", "called_strike", "missed_bunt"]
_KIND = ["FF", "SL", "CH", ""]

GOLD = f"""WITH pa AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, CASE WHEN event_id % 3 = 0 THEN 'npb_spaia' ELSE 'mlb_statcast' END AS source, CASE WHEN event_id % 3 = 0 THEN 'NPB' ELSE 'MLB' END AS league_code, 'a' || event_id AS pa_id, 'p' || user_id AS batter_id, 'p' || (user_id % 7) AS pitcher_id, {_CODES}[event_id % 12 + 1] AS event_type,
CAST(event_id % 8 AS INTEGER) AS base_state_before, CAST(event_id % 3 AS INTEGER) AS outs_before, CAST((event_id // 2) % 8 AS INTEGER) AS base_state_after, CAST((event_id // 3) % 4 AS INTEGER) AS outs_after, CAST(event_id % 3 AS BIGINT) AS runs, CASE WHEN event_id % 5 > 0 THEN CAST(event_id % 4 AS BIGINT) END AS rest, 't' || (event_id % 5) AS batting, 't' || (event_id % 4) AS fielding FROM events),
rd AS (SELECT dt, league_code, base_state_before AS base_state, outs_before AS outs, count(*) AS pa_count, sum(rest) AS runs FROM pa WHERE rest IS NOT NULL GROUP BY ALL),
re AS (SELECT league_code, base_state, outs, CAST(sum(runs) AS DOUBLE) / sum(pa_count) AS e FROM rd GROUP BY ALL),
vpa AS (SELECT pa.*, CASE WHEN event_type = 'TRUNCATED' THEN 0 ELSE 1 END AS is_pa, CASE WHEN event_type IN ('1B', '2B', '3B', 'HR', 'K', 'OUT', 'DP') THEN 1 ELSE 0 END AS is_ab, CASE WHEN event_type IN ('1B', '2B', '3B', 'HR') THEN 1 ELSE 0 END AS is_hit, CASE event_type WHEN '1B' THEN 1 WHEN '2B' THEN 2 WHEN '3B' THEN 3 WHEN 'HR' THEN 4 ELSE 0 END AS bases,
CASE WHEN outs_after >= 3 THEN 0.0 ELSE a.e END - b.e + pa.runs AS run_value, b.e AS re_before FROM pa LEFT JOIN re b ON b.league_code = pa.league_code AND b.base_state = base_state_before AND b.outs = outs_before LEFT JOIN re a ON a.league_code = pa.league_code AND a.base_state = base_state_after AND a.outs = outs_after),
snap AS (SELECT 'p' || c_custkey AS player_id, d.dt, c_custkey % 9 <> 0 OR d.dt < '2024-01-10' AS is_current, d.dt AS valid_from_dt, c_name || CASE WHEN c_custkey % 4 = 0 THEN d.dt ELSE '' END AS primary_name, c_mktsegment AS primary_position FROM customer, (SELECT unnest(['2024-01-01', '2024-01-20']) AS dt) d),
players AS (SELECT player_id, primary_name, primary_position FROM snap WHERE is_current AND dt = '2024-01-20'), teams AS (SELECT 't' || n_nationkey AS team_id, n_name AS team_name FROM nation),
pitch AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt, 'a' || l_orderkey AS pa_id, 'p' || (l_partkey % 40) AS pitcher_id, 'p' || l_suppkey AS batter_id, nullif({_KIND}[l_partkey % 4 + 1], '') AS pitch_type, {_WHAT}[l_orderkey % 6 + 1] AS result, CASE WHEN l_linenumber % 5 > 0 THEN 80 + l_quantity / 4 END AS speed, CAST(l_linenumber % 4 AS BIGINT) AS balls FROM lineitem),
game AS (SELECT DISTINCT 'g' || o_orderkey AS game_id, strftime(o_orderdate, '%Y-%m-%d') AS dt, {_TYPES}[o_custkey % 4 + 1] AS game_type, {_STATES}[o_orderkey % 5 + 1] AS status, 't' || (o_custkey % 25) AS home, 't' || (o_orderkey % 24) AS away, CASE WHEN o_orderkey % 11 > 0 THEN o_custkey % 7 END AS hs, o_orderkey % 6 AS aws FROM orders),
tg AS (SELECT game_id, dt, CASE game_type WHEN 'R' THEN 'regular' WHEN 'W' THEN 'postseason' WHEN 'A' THEN 'allstar' ELSE 'preseason' END AS phase, unnest([{{'team_id': home, 'opponent': away, 'is_home': 1, 'rs': hs, 'ra': aws}}, {{'team_id': away, 'opponent': home, 'is_home': 0, 'rs': aws, 'ra': hs}}], recursive := true) FROM game WHERE status <> 'Postponed' AND hs IS NOT NULL),
box AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt, 'g' || l_orderkey AS game_id, 'p' || (l_partkey % 60) AS player_id, 't' || (l_suppkey % 25) AS team_id, CAST(l_quantity AS BIGINT) AS outs, (CAST(l_quantity AS BIGINT) // 3) || '.' || (CAST(l_quantity AS BIGINT) % 3) AS ip, CAST(l_linenumber AS BIGINT) AS h, CAST(l_linenumber % 3 AS BIGINT) AS er, CAST(l_suppkey % 3 AS BIGINT) AS bb, CAST(l_orderkey % 9 AS BIGINT) AS so, CAST(l_partkey % 5 AS BIGINT) AS r FROM lineitem)"""


def _pick(values: list[str], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def _named(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def gold_tables(spark, sf_dir) -> dict[str, DataFrame]:
    i, u = F.col("event_id"), F.col("user_id")
    half = lambda n: F.floor(i / n).cast("long")
    pas = events(spark, sf_dir).select(
        "dt", F.when(i % 3 == 0, "npb_spaia").otherwise("mlb_statcast").alias("source"), _named("a", i).alias("pa_id"), _named("g", i % 50).alias("game_id"), _named("p", u).alias("batter_id"), _named("p", u % 7).alias("pitcher_id"), _pick(_CODES, i % 12).alias("event_type"), (i % 8).cast("int").alias("base_state_before"), (i % 3).cast("int").alias("outs_before"),
        (half(2) % 8).cast("int").alias("base_state_after"), (half(3) % 4).cast("int").alias("outs_after"), (i % 3).cast("long").alias("runs_scored_on_play"), F.when(i % 5 > 0, (i % 4).cast("long")).alias("runs_to_end_of_inning"), _named("t", i % 5).alias("batting_team_id"), _named("t", i % 4).alias("fielding_team_id"), (i % 9 + 1).cast("int").alias("inning"),
    )
    li, p, n, k = t(spark, sf_dir, "lineitem"), F.col("l_partkey"), F.col("l_linenumber"), F.col("l_orderkey")
    shipped, quantity = F.date_format("l_shipdate", "yyyy-MM-dd").alias("dt"), F.col("l_quantity").cast("long")
    pitches = li.select(shipped, F.lit("mlb_statcast").alias("source"), _named("a", k).alias("pa_id"), _named("p", p % 40).alias("pitcher_id"), _named("p", F.col("l_suppkey")).alias("batter_id"), _pick(_KIND, p % 4).alias("pitch_type"), _pick(_WHAT, k % 6).alias("result"), F.when(n % 5 > 0, 80 + F.col("l_quantity") / 4).alias("release_speed"), (n % 4).cast("long").alias("balls_before"), (n % 3).cast("long").alias("strikes_before"))
    line = [shipped, F.lit("mlb_statsapi").alias("source"), _named("g", k).alias("game_id"), _named("p", p % 60).alias("player_id"), _named("t", F.col("l_suppkey") % 25).alias("team_id")]
    ip = F.concat(F.floor(quantity / 3).cast("string"), F.lit("."), (quantity % 3).cast("string"))
    pitching = li.select(*line, ip.alias("ip"), n.cast("long").alias("h"), (n % 3).cast("long").alias("er"), (F.col("l_suppkey") % 3).cast("long").alias("bb"), (k % 9).cast("long").alias("so"), (p % 5).cast("long").alias("r"))
    batting = li.select(*line, (n + 2).cast("long").alias("ab"), n.cast("long").alias("h"), (p % 5).cast("long").alias("r"), (k % 9).cast("long").alias("rbi"), F.lit(0).cast("long").alias("2b"), F.lit(1).cast("long").alias("3b"))
    o, c, key = t(spark, sf_dir, "orders"), F.col("o_custkey"), F.col("o_orderkey")
    games = o.select(_named("g", key).alias("game_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"), F.lit("mlb_statsapi").alias("source"), _pick(_TYPES, c % 4).alias("game_type"), _pick(_STATES, key % 5).alias("status"), _named("t", c % 25).alias("home_team_id"), _named("t", key % 24).alias("away_team_id"), F.when(key % 11 > 0, c % 7).cast("long").alias("home_score"), (key % 6).cast("long").alias("away_score"))
    cu = t(spark, sf_dir, "customer").select("*", F.explode(F.array(F.lit("2024-01-01"), F.lit("2024-01-20"))).alias("dt"))
    ck = F.col("c_custkey")
    none = F.lit(None).cast("string")
    players = cu.select(_named("p", ck).alias("player_id"), "dt", ((ck % 9 != 0) | (F.col("dt") < "2024-01-10")).alias("is_current"), F.col("dt").alias("valid_from_dt"), F.concat("c_name", F.when(ck % 4 == 0, F.col("dt")).otherwise("")).alias("primary_name"), none.alias("bats"), none.alias("throws"), F.col("c_mktsegment").alias("primary_position"), F.lit("MLB").alias("league_code"))
    teams = t(spark, sf_dir, "nation").select(_named("t", F.col("n_nationkey")).alias("team_id"), F.lit("2024-01-01").alias("dt"), F.lit(True).alias("is_current"), F.lit("2024-01-01").alias("valid_from_dt"), F.col("n_name").alias("team_name"), none.alias("team_abbrev"), none.alias("home_city"), F.lit("MLB").alias("league_code"))
    return {"fact_plate_appearance": pas, "run_expectancy_daily": gold.run_expectancy_daily(pas), "fact_pitch": pitches, "fact_boxscore_pitching": pitching, "fact_boxscore_batting": batting, "fact_game": games, "dim_player": players, "dim_team": teams}


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if kind == "double" else c for c, kind in df.dtypes])


def _asked(spark, sf_dir, view: str, by: list[str], where=(), **more) -> DataFrame:
    """Every metric of a metric view."""
    tables = gold_tables(spark, sf_dir)
    measures = [n for n, m in sem.METRICS.items() if m.view == view]
    return _rounded(sem.compile_request(sem.MetricRequest(measures, by, where, **more), lambda name: sem.VIEWS[name](tables), sem.METRICS))


# Views --------------------------------------------------------------------------------------------------

@query(GOLD + " SELECT player_id, primary_name, primary_position FROM players")
def V01_player_current(spark, sf_dir):
    return sem.v_player_current(gold_tables(spark, sf_dir)).select("player_id", "primary_name", "primary_position")


@query(GOLD + " SELECT team_id, team_name FROM teams")
def V02_team_current(spark, sf_dir):
    return sem.v_team_current(gold_tables(spark, sf_dir)).select("team_id", "team_name")


@query(GOLD + " SELECT pa_id, league_code, is_pa, is_ab, is_hit, bases AS total_bases, round(re_before, 6) AS re_before, round(run_value, 6) AS run_value FROM vpa")
def V03_plate_appearances(spark, sf_dir):
    v = sem.v_plate_appearance(gold_tables(spark, sf_dir))
    return v.select("pa_id", "league_code", "is_pa", "is_ab", "is_hit", "total_bases", F.round("re_before", 6).alias("re_before"), F.round("run_value", 6).alias("run_value"))


@query(GOLD + " SELECT dt, game_id, player_id, ip, CAST(outs AS INTEGER) AS ip_outs, CAST(substr(dt, 1, 4) AS INTEGER) AS season_year FROM box")
def V05_pitching_lines(spark, sf_dir):
    return sem.v_pitching_line(gold_tables(spark, sf_dir)).select("dt", "game_id", "player_id", "ip", "ip_outs", "season_year")


@query("SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt, 'g' || l_orderkey AS game_id, 'p' || (l_partkey % 60) AS player_id, CAST(0 AS BIGINT) AS doubles, CAST(1 AS BIGINT) AS triples, 'MLB' AS league_code FROM lineitem")
def V04_batting_lines(spark, sf_dir):
    return sem.v_batting_line(gold_tables(spark, sf_dir)).select("dt", "game_id", "player_id", "doubles", "triples", "league_code")


@query(GOLD + " SELECT game_id, team_id, opponent AS opponent_team_id, CAST(is_home AS INTEGER) AS is_home, rs AS runs_scored, ra AS runs_allowed, phase AS season_phase, CAST(rs > ra AS INTEGER) AS is_win, CAST(rs = ra AS INTEGER) AS is_tie FROM tg")
def V06_team_games(spark, sf_dir):
    return sem.v_team_game(gold_tables(spark, sf_dir)).select("game_id", "team_id", "opponent_team_id", "is_home", "runs_scored", "runs_allowed", "season_phase", "is_win", "is_tie")


@query(GOLD + " SELECT pitch.dt, pitch.pa_id, pitch_type, fielding AS pitching_team_id, CAST(result IN ('swinging_strike', 'foul', 'hit_into_play', 'missed_bunt') AS INTEGER) AS is_swing, CAST(result IN ('swinging_strike', 'missed_bunt') AS INTEGER) AS is_whiff FROM pitch LEFT JOIN pa ON pa.pa_id = pitch.pa_id")
def V07_pitches(spark, sf_dir):
    return sem.v_pitch(gold_tables(spark, sf_dir)).select("dt", "pa_id", "pitch_type", "pitching_team_id", "is_swing", "is_whiff")


# Metrics ------------------------------------------------------------------------------------------------

_B = {"walks": "BB", "hit_by_pitch": "HBP", "strikeouts": "K", "sac_flies": "SF", "sac_bunts": "SH", "doubles": "2B", "triples": "3B", "home_runs": "HR"}
_COUNTS = ", ".join(f"count(*) FILTER (WHERE event_type = '{code}') AS {name}" for name, code in _B.items())


@query(GOLD + f""", s AS (SELECT v.league_code, team_name, sum(is_pa) AS pa, sum(is_ab) AS ab, sum(is_hit) AS hits, sum(bases) AS total_bases, {_COUNTS}, sum(runs) AS runs_on_play, sum(run_value) AS re24 FROM vpa v LEFT JOIN teams ON team_id = batting GROUP BY ALL)
SELECT league_code, team_name, CAST(pa AS BIGINT) AS pa, CAST(ab AS BIGINT) AS ab, CAST(hits AS BIGINT) AS hits, CAST(total_bases AS BIGINT) AS total_bases, {", ".join(_B)}, CAST(runs_on_play AS BIGINT) AS runs_on_play, round(re24, 6) AS re24, round(hits / CAST(ab AS DOUBLE), 6) AS avg, round((hits + walks + hit_by_pitch) / CAST(ab + walks + hit_by_pitch + sac_flies AS DOUBLE), 6) AS obp,
round(total_bases / CAST(ab AS DOUBLE), 6) AS slg, round((hits + walks + hit_by_pitch) / CAST(ab + walks + hit_by_pitch + sac_flies AS DOUBLE) + total_bases / CAST(ab AS DOUBLE), 6) AS ops, round(walks / CAST(pa AS DOUBLE), 6) AS bb_pct, round(strikeouts / CAST(pa AS DOUBLE), 6) AS k_pct FROM s""")
def M_batting(spark, sf_dir):
    """The metrics of plate appearances by league and team name."""
    return _asked(spark, sf_dir, "mv_batting", ["league_code", "team_name"])


@query(GOLD + " SELECT team_name, CAST(sum(outs) AS BIGINT) AS outs_recorded, count(DISTINCT game_id) AS games_pitched, CAST(sum(h) AS BIGINT) AS hits_allowed, CAST(sum(er) AS BIGINT) AS earned_runs, CAST(sum(so) AS BIGINT) AS pitcher_strikeouts, CAST(sum(bb) AS BIGINT) AS pitcher_walks, round(sum(outs) / 3.0::DOUBLE, 6) AS ip, (CAST(sum(outs) AS BIGINT) // 3) || '.' || (CAST(sum(outs) AS BIGINT) % 3) AS ip_display, round(sum(er) * 27.0::DOUBLE / sum(outs), 6) AS era, round((sum(bb) + sum(h)) * 3.0::DOUBLE / sum(outs), 6) AS whip, round(sum(so) * 27.0::DOUBLE / sum(outs), 6) AS k_per_9, round(sum(bb) * 27.0::DOUBLE / sum(outs), 6) AS bb_per_9 FROM box LEFT JOIN teams USING (team_id) GROUP BY team_name")
def M_pitching(spark, sf_dir):
    return _asked(spark, sf_dir, "mv_pitching", ["team_name"])


@query("SELECT CAST(substr(strftime(l_shipdate, '%Y-%m-%d'), 1, 4) AS INTEGER) AS season_year, CAST(sum(l_orderkey % 9) AS BIGINT) AS rbi, CAST(sum(l_partkey % 5) AS BIGINT) AS batter_runs, count(DISTINCT l_orderkey) AS box_games, round(sum(l_linenumber) / CAST(sum(l_linenumber + 2) AS DOUBLE), 6) AS box_avg FROM lineitem GROUP BY 1")
def M_batting_box(spark, sf_dir):
    return _asked(spark, sf_dir, "mv_batting_box", ["season_year"])


@query(GOLD + " SELECT team_name, CAST(substr(dt, 1, 4) AS INTEGER) AS season_year, count(*) AS games_played, count(*) FILTER (WHERE rs > ra) AS wins, count(*) FILTER (WHERE rs < ra) AS losses, count(*) FILTER (WHERE rs = ra) AS ties, CAST(sum(rs) AS BIGINT) AS runs_scored, CAST(sum(ra) AS BIGINT) AS runs_allowed, CAST(sum(rs) - sum(ra) AS BIGINT) AS run_differential, round(count(*) FILTER (WHERE rs > ra) / nullif(CAST(count(*) FILTER (WHERE rs <> ra) AS DOUBLE), 0), 6) AS win_pct FROM tg LEFT JOIN teams USING (team_id) WHERE phase IN ('regular', 'unknown') GROUP BY ALL")
def M_team_games(spark, sf_dir):
    """The metrics of teams' games; other phases than the regular season are left out by default."""
    return _asked(spark, sf_dir, "mv_team_games", ["team_name", "season_year"])


@query(GOLD + " SELECT pitch_type, balls AS balls_before, count(*) AS pitches, count(*) FILTER (WHERE result IN ('swinging_strike', 'foul', 'hit_into_play', 'missed_bunt')) AS swings, count(*) FILTER (WHERE result IN ('swinging_strike', 'missed_bunt')) AS whiffs, round(avg(speed), 6) AS avg_velocity, max(speed) AS max_velocity, round(count(*) FILTER (WHERE result IN ('swinging_strike', 'missed_bunt')) / nullif(CAST(count(*) FILTER (WHERE result IN ('swinging_strike', 'foul', 'hit_into_play', 'missed_bunt')) AS DOUBLE), 0), 6) AS whiff_rate FROM pitch WHERE pitch_type IS NOT NULL GROUP BY ALL")
def M_pitches(spark, sf_dir):
    return _asked(spark, sf_dir, "mv_pitches", ["pitch_type", "balls_before"], [("pitch_type", "not_null", None)])


@query(GOLD + ", l AS (SELECT unnest(range(8)) AS b, unnest(['Bases empty', '1st', '2nd', '1st & 2nd', '3rd', '1st & 3rd', '2nd & 3rd', 'Loaded']) AS runners) SELECT league_code, runners, outs, round(CAST(sum(runs) AS DOUBLE) / sum(pa_count), 6) AS exp_runs, CAST(sum(pa_count) AS BIGINT) AS re_pa_count FROM rd JOIN l ON b = base_state GROUP BY ALL")
def M_run_expectancy(spark, sf_dir):
    return _asked(spark, sf_dir, "mv_run_expectancy", ["league_code", "runners", "outs"])


# Dashboard ----------------------------------------------------------------------------------------------

@query(GOLD + " SELECT '2024' AS season, (SELECT count(DISTINCT game_id) FROM game WHERE dt LIKE '2024%') AS games, (SELECT count(*) FROM pa WHERE dt LIKE '2024%') AS plate_appearances, (SELECT count(*) FROM pitch WHERE dt LIKE '2024%') AS pitches, (SELECT count(*) FROM players) AS players, (SELECT count(DISTINCT dt) FROM game WHERE dt LIKE '2024%') AS days_loaded, (SELECT max(dt) FROM game WHERE dt LIKE '2024%') AS latest_day")
def E09_totals(spark, sf_dir):
    return db.totals(gold_tables(spark, sf_dir), 2024)


@query(GOLD + ", f AS (SELECT dt AS day, CASE source WHEN 'mlb_statcast' THEN 'MLB (Statcast)' ELSE 'NPB' END AS feed FROM pa) SELECT CASE grouping(day, feed) WHEN 0 THEN 'day and feed' WHEN 1 THEN 'day' WHEN 2 THEN 'feed' ELSE 'season' END AS level, day, feed, count(*) AS plate_appearances FROM f GROUP BY CUBE (day, feed)")
def E09_coverage(spark, sf_dir):
    """Plate appearances at four levels from one scan."""
    return db.daily_coverage(gold_tables(spark, sf_dir)["fact_plate_appearance"], 2024).withColumn("day", F.col("day").cast("string"))


@query("""WITH r AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS check_name, CASE WHEN value > 400 THEN 'fail' WHEN value < 5 THEN 'skip' ELSE 'pass' END AS status FROM events)
SELECT CASE grouping(day, check_name) WHEN 0 THEN 'check and day' WHEN 1 THEN 'day' WHEN 2 THEN 'check' ELSE 'season' END AS level, day, check_name, count(*) FILTER (WHERE status = 'pass') AS passed, count(*) FILTER (WHERE status = 'fail') AS failed, count(*) FILTER (WHERE status = 'skip') AS skipped FROM r GROUP BY CUBE (day, check_name)""")
def E09_quality(spark, sf_dir):
    results = events(spark, sf_dir).select("dt", F.col("event_type").alias("check_name"), F.when(F.col("value") > 400, "fail").when(F.col("value") < 5, "skip").otherwise("pass").alias("status"))
    return db.quality_results(results, 2024).withColumn("day", F.col("day").cast("string"))


@query(GOLD + ", c AS (SELECT base_state, outs, CAST(sum(runs) AS DOUBLE) / sum(pa_count) AS e, sum(pa_count) AS n FROM rd WHERE league_code = 'MLB' GROUP BY ALL) SELECT base_state, ['Bases empty', '1st', '2nd', '1st & 2nd', '3rd', '1st & 3rd', '2nd & 3rd', 'Loaded'][base_state + 1] AS runners, round(max(CASE WHEN outs = 0 THEN e END), 6) AS outs_0, round(max(CASE WHEN outs = 1 THEN e END), 6) AS outs_1, round(max(CASE WHEN outs = 2 THEN e END), 6) AS outs_2, CAST(sum(n) AS BIGINT) AS plate_appearances FROM c GROUP BY base_state")
def E09_run_expectancy(spark, sf_dir):
    return _rounded(db.run_expectancy(gold_tables(spark, sf_dir), 2024))


@query(GOLD + " SELECT pitch_type AS pitch, count(*) AS pitches, round(avg(speed), 6) AS avg_mph, max(speed) AS max_mph FROM pitch WHERE pitch_type IS NOT NULL AND dt LIKE '1995%' GROUP BY 1 HAVING count(*) >= 50")
def E09_pitch_mix(spark, sf_dir):
    return _rounded(db.pitch_mix(gold_tables(spark, sf_dir), 1995))


@query(GOLD + " SELECT batter_id, primary_name AS batter, CAST(sum(is_pa) AS BIGINT) AS pa, count(*) FILTER (WHERE event_type = 'HR') AS hr, CAST(sum(is_hit) AS BIGINT) AS hits, count(*) FILTER (WHERE event_type = 'BB') AS bb, count(*) FILTER (WHERE event_type = 'K') AS k, round(sum(is_hit) / CAST(sum(is_ab) AS DOUBLE), 6) AS avg FROM vpa LEFT JOIN players ON player_id = batter_id WHERE source = 'mlb_statcast' GROUP BY ALL HAVING sum(is_pa) >= 20 ORDER BY hr DESC, pa DESC, batter_id LIMIT 25")
def E09_hitters(spark, sf_dir):
    return _rounded(db.hitters(gold_tables(spark, sf_dir), 2024))


@query(GOLD + " SELECT team_id, team_name AS team, count(*) FILTER (WHERE rs > ra) AS w, count(*) FILTER (WHERE rs < ra) AS l, round(count(*) FILTER (WHERE rs > ra) / nullif(CAST(count(*) FILTER (WHERE rs <> ra) AS DOUBLE), 0), 6) AS pct, CAST(sum(rs) - sum(ra) AS BIGINT) AS run_diff FROM tg LEFT JOIN teams USING (team_id) WHERE phase = 'regular' AND dt LIKE '1995%' GROUP BY ALL")
def E09_standings(spark, sf_dir):
    return _rounded(db.standings(gold_tables(spark, sf_dir), 1995))


@query(GOLD + ", last AS (SELECT max(dt) AS dt FROM pa) SELECT last.dt, league_code, base_state, outs, CAST(sum(pa_count) AS BIGINT) AS pa_count, CAST(sum(runs) AS BIGINT) AS runs FROM rd, last GROUP BY ALL")
def E10_run_expectancy_of_season(spark, sf_dir):
    """The season-to-date matrix as of the season's latest day."""
    tables = gold_tables(spark, sf_dir)
    matrix = gold.run_expectancy(tables["run_expectancy_daily"], tables["fact_plate_appearance"].select("dt"))
    return db.run_expectancy_of_season(matrix, 2024).select("dt", "league_code", "base_state", "outs", "pa_count", "runs")


# Facts and dimensions -----------------------------------------------------------------------------------

def _known(value: str, entity: str, source: str, known: str) -> str:
    """SQL of the bridge's id where ``known`` holds, else of the derived one."""
    derived = id_sql("'" + f"{entity}:source:{source}:" + "' || " + value)
    return f"CASE WHEN {value} IS NULL THEN NULL WHEN {known} THEN '{entity[0].upper()}' || {value} ELSE {derived} END"


def _bridge(spark, sf_dir, source: str) -> DataFrame:
    """Even teams, and players whose number has no rest by three, are known."""
    entry = lambda kind, ids: ids.select(F.lit(kind).alias("entity_type"), F.lit(source).alias("source"), F.col("id").cast("string").alias("source_id"), F.concat(F.lit(kind[0].upper()), F.col("id").cast("string")).alias("canonical_id"))
    teams = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id")).where("id % 2 = 0")
    players = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")).where("id % 3 = 0")
    return entry("team", teams).unionByName(entry("player", players))


def _silver_games(spark, sf_dir) -> DataFrame:
    key, c = F.col("o_orderkey"), F.col("o_custkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    team = lambda x: F.when(x < 23, x).cast("string")
    return t(spark, sf_dir, "orders").select(
        key.cast("string").alias("game_id"), F.when(key % 4 > 0, day).otherwise("").alias("game_date"), team(c % 25).alias("home_team_id"), team(key % 24).alias("away_team_id"), F.concat(F.lit("N"), (c % 25).cast("string")).alias("home_team_name"), F.concat(F.lit("N"), (key % 24).cast("string")).alias("away_team_name"),
        (c % 7).alias("home_score"), (key % 6).alias("away_score"), F.lit("park").alias("venue"), F.when(key % 5 > 0, F.col("o_orderstatus")).otherwise("").alias("status"), _pick(_TYPES, c % 4).alias("game_type"), day.alias("dt"),
    )


_HOME, _AWAY = "CASE WHEN o_custkey % 25 < 23 THEN CAST(o_custkey % 25 AS VARCHAR) END", "CASE WHEN o_orderkey % 24 < 23 THEN CAST(o_orderkey % 24 AS VARCHAR) END"


@query(f"""WITH g AS (SELECT *, {_HOME} AS ht, {_AWAY} AS aw, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders) SELECT {id_sql("'game:mlb_statsapi:' || o_orderkey")} AS game_id, {id_sql("'season:MLB:' || substr(dt, 1, 4)")} AS season_id, dt AS game_date, {_known("ht", "team", "mlb_statsapi", "CAST(ht AS INTEGER) % 2 = 0")} AS home_team_id,
{_known("aw", "team", "mlb_statsapi", "CAST(aw AS INTEGER) % 2 = 0")} AS away_team_id, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus ELSE 'unknown' END AS status, {_TYPES}[o_custkey % 4 + 1] AS game_type, CAST(o_custkey % 7 AS BIGINT) AS home_score, CAST(o_orderkey AS VARCHAR) AS source_game_id FROM g""")
def P20_fact_game(spark, sf_dir):
    found = gold.fact_game({("mlb_statsapi", "games"): _silver_games(spark, sf_dir)}, _bridge(spark, sf_dir, "mlb_statsapi"))
    return found.select("game_id", "season_id", "game_date", "home_team_id", "away_team_id", "status", "game_type", "home_score", "source_game_id")


def _silver_pitches(spark, sf_dir) -> DataFrame:
    k, n, p, s = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    return t(spark, sf_dir, "lineitem").select(k.cast("string").alias("game_pk"), n.cast("long").alias("at_bat_number"), p.cast("long").alias("pitch_number"), (p % 90).cast("string").alias("batter_id"), s.cast("string").alias("pitcher_id"), (n % 4).alias("balls"), (n % 3).alias("strikes"), _pick(_KIND, p % 4).alias("pitch_type"), F.col("l_quantity").alias("release_speed"), F.lit(0.5).alias("plate_x"), F.lit(1.5).alias("plate_z"), _pick(_WHAT, k % 6).alias("description"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("dt"))


@query(f"""WITH l AS (SELECT *, CAST(l_partkey % 90 AS VARCHAR) AS b, CAST(l_suppkey AS VARCHAR) AS p FROM lineitem) SELECT {id_sql("'pitch:mlb_statcast:' || l_orderkey || ':' || l_linenumber || ':' || l_partkey")} AS pitch_id, {id_sql("'pa:mlb_statcast:' || l_orderkey || ':' || l_linenumber")} AS pa_id,
{_known("b", "player", "mlb_statsapi", "l_partkey % 90 % 3 = 0")} AS batter_id, {_known("p", "player", "mlb_statsapi", "l_suppkey % 3 = 0 AND l_suppkey <= (SELECT max(c_custkey) FROM customer)")} AS pitcher_id, {_KIND}[l_partkey % 4 + 1] AS pitch_type, {_WHAT}[l_orderkey % 6 + 1] AS result FROM l""")
def P21_fact_pitch(spark, sf_dir):
    return gold.fact_pitch(_silver_pitches(spark, sf_dir), _bridge(spark, sf_dir, "mlb_statsapi")).select("pitch_id", "pa_id", "batter_id", "pitcher_id", "pitch_type", "result")


@query(f"""WITH r AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS dt, CAST(o_orderkey % 23 AS VARCHAR) AS t, CAST(o_custkey AS VARCHAR) AS p FROM orders WHERE o_orderstatus <> 'P') SELECT {_known("t", "team", "npb_spaia", "CAST(t AS INTEGER) % 2 = 0")} AS team_id, {_known("p", "player", "npb_spaia", "CAST(p AS INTEGER) % 3 = 0")} AS player_id, {id_sql("'season:NPB:' || substr(dt, 1, 4)")} AS season_id, dt FROM r""")
def P21_fact_roster(spark, sf_dir):
    """Rosters without staff, each player and team of a day once."""
    rows = t(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"), (F.col("o_orderkey") % 23).cast("string").alias("team_id"), F.col("o_custkey").cast("string").alias("player_id"), F.when(F.col("o_orderstatus") == "P", "coach").otherwise("player").alias("role"))
    return gold.fact_roster({("npb_spaia", "rosters"): rows.unionByName(rows)}, _bridge(spark, sf_dir, "npb_spaia")).select("team_id", "player_id", "season_id", "dt")


@query(f"""WITH l AS (SELECT *, CAST(l_suppkey % 23 AS VARCHAR) AS t, CAST(l_partkey % 90 AS VARCHAR) AS p FROM lineitem) SELECT {id_sql("'game:mlb_statsapi:' || l_orderkey")} AS game_id, {_known("t", "team", "mlb_statsapi", "l_suppkey % 23 % 2 = 0")} AS team_id, {_known("p", "player", "mlb_statsapi", "l_partkey % 90 % 3 = 0")} AS player_id,
CAST(l_linenumber + 2 AS BIGINT) AS ab, CAST(l_linenumber AS BIGINT) AS h, CAST(NULL AS BIGINT) AS hr FROM l""")
def P22_fact_boxscore(spark, sf_dir):
    """Batting lines of a source; statistics that it lacks are null."""
    li = t(spark, sf_dir, "lineitem")
    lines = li.select(F.col("l_orderkey").cast("string").alias("game_id"), (F.col("l_suppkey") % 23).cast("string").alias("team_id"), (F.col("l_partkey") % 90).cast("string").alias("player_id"), (F.col("l_linenumber") + 2).alias("ab"), F.col("l_linenumber").alias("h"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("dt"))
    return gold.fact_boxscore({("mlb_statsapi", "boxscore_batting"): lines}, _bridge(spark, sf_dir, "mlb_statsapi"), "boxscore_batting").select("game_id", "team_id", "player_id", "ab", "h", "hr")


@query(f"""WITH y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), s AS (SELECT unnest(['MLB', 'NPB', 'INDY', 'KBO', 'LMB']) AS c, unnest(['03-01', '03-01', '04-01', '03-01', '03-01']) AS a, unnest(['11-30', '11-30', '10-31', '10-31', '09-30']) AS b)
SELECT {id_sql("'season:' || c || ':' || y")} AS season_id, c AS league_code, CAST(y AS INTEGER) AS season_year, y || '-' || a AS season_start_dt, y || '-' || b AS season_end_dt FROM y, s""")
def P23_dim_season(spark, sf_dir):
    years = t(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct().withColumn("dt", F.lit("2024-01-01"))
    return gold.dim_season(years).select("season_id", "league_code", "season_year", "season_start_dt", "season_end_dt")


@query("""WITH r AS (SELECT 'MLB' AS league, CAST(o_custkey AS VARCHAR) AS id, min(o_orderpriority) AS name FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey) SELECT 'p' || id AS player, CASE WHEN CAST(id AS INTEGER) % 50 = 0 THEN 'manual' ELSE 'exact_id' END AS match_method, CASE WHEN CAST(id AS INTEGER) % 50 = 0 THEN 1.0::DOUBLE ELSE 0.9::DOUBLE END AS confidence, CAST(id AS INTEGER) % 50 = 0 AS manual_override FROM r""")
def N01_identity(spark, sf_dir):
    """The bridge of one day's rosters with overrides by hand, one row a player whatever lists name them."""
    o = t(spark, sf_dir, "orders")
    rosters = o.where("o_orderstatus <> 'P'").select(F.lit("2024-01-01").alias("dt"), F.col("o_custkey").cast("string").alias("player_id"), F.col("o_orderpriority").alias("player_name"), F.lit("t1").alias("team_id"))
    overrides = o.where("o_custkey % 50 = 0").select(F.lit("player").alias("entity_type"), F.lit("mlb_statsapi").alias("source"), F.col("o_custkey").cast("string").alias("source_id"), F.lit("BY-HAND").alias("canonical_id")).distinct()
    found = gold.resolve(gold.collected({("mlb_statsapi", "rosters"): rosters}), overrides)
    return found.select(F.concat(F.lit("p"), "source_id").alias("player"), "match_method", "confidence", "manual_override")


@query("SELECT DISTINCT 'p' || o_custkey AS player, 'manual_override' AS match_method, dt FROM orders, (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt FROM events) WHERE o_custkey % 50 = 0 AND o_orderstatus = 'F'")
def N01_merge_events(spark, sf_dir):
    """The audit of overrides, on each day they are applied to; those without an id are none."""
    o = t(spark, sf_dir, "orders").where("o_custkey % 50 = 0")
    overrides = o.select(F.lit("player").alias("entity_type"), F.lit("s").alias("source"), F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("source_id"), F.when(F.col("o_orderstatus") == "F", "ID").alias("canonical_id"))
    return gold.merge_events(overrides, events(spark, sf_dir)).select(F.col("source_id").alias("player"), "match_method", "dt")


_FLAGS = ["single", "double", "triple", "hr", "walk", "k", "othout"]


@query(f"""WITH e AS (SELECT *, event_id % 7 AS f FROM events) SELECT {id_sql("'pa:retrosheet:g' || user_id || ':' || event_id")} AS pa_id, CAST(event_id % 9 + 1 AS BIGINT) AS inning, event_id % 2 = 0 AS is_top_inning, ['1B', '2B', '3B', 'HR', 'BB', 'K', 'OUT'][f + 1] AS event_type, CAST((event_id % 2) + 2 * CAST(event_id % 3 = 1 AS INTEGER) AS BIGINT) AS base_state_before, CAST(event_id % 3 AS BIGINT) AS outs_before, CAST(event_id % 2 AS BIGINT) AS outs_on_play FROM e""")
def T03_play_file(spark, sf_dir):
    """Plate appearances of a play file whose results are flags."""
    i = F.col("event_id")
    on = lambda c: F.when(c, "r").otherwise("")
    rows = t(spark, sf_dir, "events").select(
        F.concat(F.lit("g"), F.col("user_id").cast("string")).alias("game_id"), i.cast("string").alias("event_id"), (i % 9 + 1).cast("string").alias("inning"), (i % 2).cast("string").alias("top_bottom"), *[F.when(i % 7 == n, "1").otherwise("0").alias(c) for n, c in enumerate(_FLAGS)], F.lit("b").alias("batter_id"), F.lit("p").alias("pitcher_id"), F.lit("t").alias("batting_team_id"), F.lit("u").alias("pitching_team_id"),
        on(i % 2 == 1).alias("br1_pre"), on(i % 3 == 1).alias("br2_pre"), F.lit("").alias("br3_pre"), *[F.lit("").alias(f"br{n}_post") for n in (1, 2, 3)], (i % 3).cast("string").alias("outs_pre"), (i % 3 + i % 2).cast("string").alias("outs_post"), F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )
    found = plays.from_play_file(rows, spark.createDataFrame([], gold.BRIDGE))
    return found.select("pa_id", "inning", "is_top_inning", "event_type", "base_state_before", "outs_before", "outs_on_play")


@query(f"""WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS later FROM events), q AS (SELECT *, later IS NOT NULL AND n % 3 > 0 AS goes_on, n % 3 = 0 AND event_id % 11 = 0 AS cut FROM e)
SELECT {id_sql("'pa:npb:' || user_id || ':' || ((n - 1) // 6 + 1) || ':' || (((n - 1) // 3) % 2 + 1) || ':' || ((n - 1) % 3 + 1)")} AS pa_id, CAST((n - 1) // 6 + 1 AS BIGINT) AS inning, ((n - 1) // 3) % 2 = 0 AS is_top_inning, CASE WHEN cut THEN 'TRUNCATED' ELSE ['K', 'BB', 'HR', '2B'][event_id % 4 + 1] END AS event_type, CAST((n - 1) % 3 AS BIGINT) AS outs_before,
CAST(CASE WHEN goes_on THEN n % 3 WHEN cut AND later IS NULL THEN 2 ELSE 3 END AS BIGINT) AS outs_after, CAST([0, 1, 3][event_id % 3 + 1] AS BIGINT) AS base_state_before, CAST(CASE WHEN goes_on THEN [0, 1, 3][later % 3 + 1] WHEN cut AND later IS NULL THEN NULL ELSE 0 END AS BIGINT) AS base_state_after, CAST(0 AS BIGINT) AS runs_scored_on_play FROM q""")
def T02_text_plays(spark, sf_dir):
    """Plate appearances from play-by-play text: headers, pitches and results; some halves end without one."""
    i = F.col("event_id")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    e = t(spark, sf_dir, "events").withColumn("n", n)
    header = F.concat(_pick(["無死", "一死", "二死"], (F.col("n") - 1) % 3), _pick(["走者なし", "一塁", "一二塁"], i % 3))
    parts = F.array(F.struct(F.lit("6").alias("kind"), header.alias("text")), F.struct(F.lit("0").alias("kind"), F.lit("ストライク").alias("text")), F.struct(F.lit("1").alias("kind"), _pick(["空振り三振", "四球", "本塁打", "二塁打"], i % 4).alias("text")))
    rows = e.select("*", F.posexplode(parts).alias("step", "x")).where(~((F.col("step") == 2) & (F.col("n") % 3 == 0) & (i % 11 == 0)))
    whole = lambda c, k: F.floor(c / k).cast("long")
    at = F.col("n") * 10 + F.col("step")
    plays_in = rows.select(
        F.col("user_id").cast("string").alias("game_id"), (whole(F.col("n") - 1, 6) + 1).alias("inning"), (whole(F.col("n") - 1, 3) % 2 + 1).cast("string").alias("top_bottom"), ((F.col("n") - 1) % 3 + 1).cast("long").alias("play_ab"), at.cast("long").alias("play_seq_no"), at.cast("string").alias("event_id"), F.lit("9").alias("play_player_id"),
        F.col("x.text").alias("text_info_text"), F.to_json(F.struct(F.col("x.kind").alias("TextInfo_Bat_Text_Sec"))).alias("raw_event_json"), F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )
    found = plays.from_text(plays_in, spark.createDataFrame([], gold.BRIDGE))
    return found.select("pa_id", "inning", "is_top_inning", "event_type", "outs_before", "outs_after", "base_state_before", "base_state_after", "runs_scored_on_play")


# Entities -----------------------------------------------------------------------------------------------

def _batched(spark, sf_dir) -> DataFrame:
    """Events as responses of a day for each user, batched as the source's games are; every 13th response is no JSON."""
    e = events(spark, sf_dir)
    record = F.struct(F.col("event_id").cast("string").alias("PlayerID"), "value")
    one = e.groupBy("dt", F.col("user_id").cast("string").alias("game_id")).agg(F.to_json(F.struct(F.sort_array(F.collect_list(record)).alias("data"))).alias("body_text"))
    one = one.withColumn("body_text", F.when(F.col("game_id").cast("long") % 13 == 0, "<html>").otherwise(F.col("body_text")))
    return one.groupBy("dt").agg(F.to_json(F.struct(F.collect_list(F.struct("game_id", "body_text")).alias("games"))).alias("body_text"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS dt, CAST(user_id AS VARCHAR) AS game_id, event_id, value FROM events WHERE user_id % 13 > 0")
def P11_game_stats(spark, sf_dir):
    """Records of batched responses by game, whole and with their JSON."""
    rows = en.normalised(en.by_name(en.NPB, "game_batter_stats"), _batched(spark, sf_dir))
    return rows.select("dt", "game_id", F.get_json_object("raw_json", "$.PlayerID").cast("long").alias("event_id"), F.get_json_object("raw_json", "$.value").cast("double").alias("value"))


@query("SELECT '1995-01-01' AS dt, CAST(n_nationkey AS VARCHAR) AS team_id, n_name AS team_name, CAST(n_regionkey AS BIGINT) AS w, CAST(0 AS BIGINT) AS l, CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey AS BIGINT) END AS t, '.' || n_nationkey AS pct FROM nation")
def P11_standings(spark, sf_dir):
    """Standings by their specification: typed columns, zeros kept."""
    k = F.col("n_nationkey")
    n = t(spark, sf_dir, "nation").select(F.lit("1995-01-01").alias("dt"), F.struct(k.alias("TeamID"), F.col("n_name").alias("TeamName"), F.col("n_regionkey").alias("Win"), F.lit(0).alias("Lose"), F.when(k % 2 == 0, k.cast("string")).otherwise("-").alias("Tie"), F.concat(F.lit("."), k.cast("string")).alias("WinRate")).alias("r"))
    body = n.groupBy("dt").agg(F.to_json(F.struct(F.collect_list("r").alias("standings"))).alias("body_text"))
    return en.normalised(en.by_name(en.NPB, "standings"), body).select("dt", "team_id", "team_name", "w", "l", "t", "pct")


@query("SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS dt, CAST(o_custkey AS VARCHAR) AS team_id FROM orders WHERE o_custkey % 10 > 0")
def N08_fan_out(spark, sf_dir):
    """Each id that a day's records name, once, whatever the number of records."""
    c = F.col("o_custkey")
    raw = t(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"), F.to_json(F.struct(F.when(c % 2 == 0, F.when(c % 10 == 0, "").otherwise(c.cast("string"))).alias("TeamID"), F.when(c % 2 == 1, c).alias("team_id"))).alias("raw_json"))
    return en.fan_out(en.by_name(en.NPB, "rosters"), raw, ["TeamID", "team_id"])


@query("WITH l AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt, CAST(o_custkey AS VARCHAR) AS player_id, min(o_orderstatus) AS name FROM orders GROUP BY ALL), r AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS dt, CAST(o_custkey AS VARCHAR) AS player_id FROM orders WHERE o_orderstatus = 'F') SELECT dt, player_id, name FROM l ANTI JOIN r USING (dt, player_id)")
def J04_unlisted(spark, sf_dir):
    """Players of the season's list who are on no roster of the day."""
    o = t(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"), F.col("o_custkey").cast("string").alias("player_id"), F.col("o_orderstatus").alias("name"))
    return en.unlisted(o, o.where("name = 'F'"))


@query("SELECT DISTINCT 'txn' || o_orderkey AS transaction, CASE WHEN o_orderkey % 4 > 0 THEN 't' || (o_custkey % 25) END AS team, 'p' || o_custkey AS player, o_orderstatus AS transaction_type, strftime(o_orderdate, '%Y-%m-%d') AS effective_dt FROM orders")
def P21_transactions(spark, sf_dir):
    """Moves with the bridge's ids; those that the bridge lacks are derived, which the query leaves out."""
    o, c = t(spark, sf_dir, "orders"), F.col("o_custkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    moves = o.select(F.col("o_orderkey").cast("string").alias("transaction_id"), F.when(F.col("o_orderkey") % 4 > 0, (c % 25).cast("string")).alias("team_id"), c.cast("string").alias("player_id"), F.col("o_orderstatus").alias("type_desc"), day.alias("date"), F.concat(F.lit("txn"), F.col("o_orderkey").cast("string")).alias("description"), day.alias("dt"))
    entries = lambda kind, prefix, ids: ids.select(F.lit(kind).alias("entity_type"), F.lit("mlb_statsapi").alias("source"), F.col("id").cast("string").alias("source_id"), F.concat(F.lit(prefix), F.col("id").cast("string")).alias("canonical_id"))
    bridge = entries("team", "t", o.select((c % 25).alias("id")).distinct()).unionByName(entries("player", "p", o.select(c.alias("id")).distinct()))
    found = gold.fact_transaction(moves.unionByName(moves.where("team_id is null")), bridge)
    return found.select(F.col("details").alias("transaction"), F.col("team_id").alias("team"), F.col("player_id").alias("player"), "transaction_type", "effective_dt")


@query("SELECT o_orderkey, round(o_totalprice / 7, 6) AS share, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 2 = 0 AS even FROM orders")
def P27_json_safe(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") / 7).alias("share"), F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") % 2 == 0).alias("even"))
    return sem.json_safe(o)


# Files --------------------------------------------------------------------------------------------------

def _folder(spark, name: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').removeprefix('file:')}/{name}-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders WHERE o_orderdate BETWEEN DATE '1994-12-20' AND DATE '1995-01-10'")
def S11_sharded_csv(spark, sf_dir):
    """A range of days from files by season; days are written as digits in one season, as ISO text in others."""
    root = _folder(spark, "shards")
    o = t(spark, sf_dir, "orders").withColumn("season", F.year("o_orderdate"))
    day = F.when(F.col("season") == 1995, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    o.select("o_orderkey", "o_custkey", day.alias("date"), "season").write.partitionBy("season").option("header", "true").csv(root)
    return lake.csv_range(spark, root, "o_orderkey long, o_custkey long, date string", "date", "1994-12-20", "1995-01-10").select("o_orderkey", "o_custkey", "dt")


@query("WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS dt FROM events WHERE event_id % 97 > 0) SELECT 'events' AS table_name, 'partial' AS status, count(*) AS rows, (SELECT count(*) FROM events WHERE event_id % 97 = 0) AS bad_rows, count(DISTINCT dt) AS days, CAST(count(*) AS BIGINT) AS there FROM e")
def S10_counted_records(spark, sf_dir):
    """Records of JSON lines, every 97th broken: written, counted and audited by one job."""
    root = _folder(spark, "records")
    e = events(spark, sf_dir)
    text = F.to_json(F.struct("event_id", "dt", "value"))
    e.select(F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("{broken "), text)).otherwise(text).alias("value")).write.text(f"{root}/raw")
    days = [r.dt for r in e.select("dt").distinct().collect()]
    lake.counted_write(lake.json_lines(spark, f"{root}/raw", "event_id long, dt string, value double"), root, "events", days, "ingest")
    there = lake.read(spark, root, "events").agg(F.count("*").alias("there"))
    audit = lake.read(spark, root, "audit_run").select("table_name", "status", "rows", "bad_rows", "days")
    return audit.join(F.broadcast(there))  # one row each
