"""Plate appearances, run expectancy, semantic metrics on a small hand-worked season of two days."""

import json
import random

import pytest
from pyspark.sql import functions as F

from infield.functions import columns as fx
from infield.operators import gold, plays
from infield.plans import semantic as sem

PITCH = "game_pk string, at_bat_number long, pitch_number long, inning long, inning_topbot string, outs_when_up long, on_1b string, on_2b string, on_3b string, events string, description string, pitch_type string, release_speed double, plate_x double, plate_z double, balls long, strikes long, batter_id string, pitcher_id string, raw_json string, dt string"
DAY1, DAY2 = "2026-05-01", "2026-05-02"


def pitch(ab, n, half, outs, bases, event, score, after=None, batter="1", description="ball"):
    on = [b if b in bases else None for b in "123"]
    raw = {"bat_score": score, "post_bat_score": score if after is None else after}
    return ("1001", ab, n, 1 if half == "Bot" else 2, half, outs, *on, event, description, "FF", 95.0, 0.0, 2.0, 0, 0, batter, "9", json.dumps(raw), DAY1)


PITCHES = [
    pitch(1, 1, "Bot", 0, "", None, 0, description="swinging_strike"), pitch(1, 2, "Bot", 0, "", "single", 0, description="hit_into_play"),
    pitch(2, 1, "Bot", 0, "1", "home_run", 0, 2, description="hit_into_play_score"), pitch(3, 1, "Bot", 0, "", "strikeout", 2, description="swinging_strike"),
    pitch(4, 1, "Bot", 1, "", "walk", 2), pitch(5, 1, "Bot", 1, "1", "field_out", 2, description="hit_into_play"), pitch(6, 1, "Bot", 2, "1", "double", 2, description="hit_into_play_no_out"),
    pitch(7, 1, "Bot", 2, "23", "", 2, 3), pitch(8, 1, "Top", 0, "12", "triple_play", 0, 0, batter="2"),
]


@pytest.fixture(scope="module")
def tables(spark):
    pitches = spark.createDataFrame(PITCHES, PITCH)
    games = spark.createDataFrame([("1001", DAY1, "10", "New York", "20", "Boston", "Final", "R", 3, 0)] , "game_id string, game_date string, home_team_id string, home_team_name string, away_team_id string, away_team_name string, status string, game_type string, home_score long, away_score long").withColumn("dt", F.lit(DAY1))
    more = spark.createDataFrame([("1001", DAY2, "10", "New York", "20", "Boston", "Final", "R", 3, 0), ("1002", DAY2, "20", "Boston", "10", "New York", "Final", "A", 1, 2), ("1003", DAY2, "20", "Boston", "10", "New York", "Postponed", "R", None, None), ("1004", DAY2, "20", "Boston", "10", "New York", "Final", "R", 4, 4)], "game_id string, game_date string, home_team_id string, home_team_name string, away_team_id string, away_team_name string, status string, game_type string, home_score long, away_score long").withColumn("dt", F.lit(DAY2))
    rosters = spark.createDataFrame([("10", "1", "Ann", "CF", DAY1), ("10", "1", "Ann B", "CF", DAY2), ("20", "2", "Bo", "P", DAY2)], "team_id string, player_id string, player_name string, position string, dt string")
    box = spark.createDataFrame([("1001", "10", "9", "6.2", 5, 1, 1, 2, 7, 0, DAY1), ("1001", "20", "8", "0.1", 1, 2, 2, 0, 0, 1, DAY1)], "game_id string, team_id string, player_id string, ip string, h long, r long, er long, bb long, so long, hr long, dt string")
    kbo = spark.createDataFrame([("k1", "30", "Kim", 3, 1, 0, 0, DAY1), ("k1", "30", "Kim", 2, 0, 0, 0, DAY1)], "game_id string, team_id string, player_name string, ab long, h long, rbi long, r long, dt string")
    silver = {("mlb_statcast", "pitches"): pitches, ("mlb_statsapi", "games"): games.unionByName(more), ("mlb_statsapi", "rosters"): rosters, ("mlb_statsapi", "boxscore_pitching"): box, ("kbo_api", "boxscore_batting"): kbo}
    overrides = spark.createDataFrame([("player", "mlb_statsapi", "2", "MANUAL")], "entity_type string, source string, source_id string, canonical_id string")
    bridge = gold.resolve(gold.collected(silver), overrides).cache()
    fact_game = gold.fact_game(silver, bridge)
    pas = gold.fact_plate_appearance(silver, bridge, fact_game).cache()
    daily = gold.run_expectancy_daily(pas)
    previous = gold.dim_player_rows(silver, bridge).where(F.col("dt") == DAY1)
    out = {"bridge": bridge, "fact_game": fact_game, "fact_plate_appearance": pas, "run_expectancy_daily": daily, "fact_pitch": gold.fact_pitch(pitches, bridge), "fact_boxscore_pitching": gold.fact_boxscore(silver, bridge, "boxscore_pitching"), "fact_boxscore_batting": gold.fact_boxscore(silver, bridge, "boxscore_batting")}
    out["dim_player"] = gold.dim_player_rows(silver, bridge).withColumns({"valid_from_dt": F.col("dt"), "valid_to_dt": F.lit(None).cast("string"), "is_current": F.lit(True)})
    out["dim_team"] = gold.dim_team_rows(silver, bridge).withColumns({"valid_from_dt": F.col("dt"), "valid_to_dt": F.lit(None).cast("string"), "is_current": F.lit(True)})
    out["_previous"] = previous
    return out


def metric(tables, names, dimensions=(), **kw):
    views = {}

    def view(name):
        views.setdefault(name, sem.VIEWS[name](tables))
        return views[name]

    return sem.compile_request(sem.MetricRequest(names, dimensions, **kw), view).collect()


def test_plate_appearances(tables):
    rows = tables["fact_plate_appearance"].orderBy(F.col("is_top_inning"), "inning", F.desc("runs_to_end_of_inning"), "outs_before").collect()
    by = {(r.event_type, r.base_state_before, r.outs_before): r for r in rows}
    assert len(rows) == 8
    assert by["1B", 0, 0].runs_to_end_of_inning == 3 and by["HR", 1, 0].runs_scored_on_play == 2
    assert by["TRUNCATED", 6, 2].runs_scored_on_play == 1 and by["TRUNCATED", 6, 2].outs_after == 3
    assert by["TP", 3, 0].outs_after == 3 and by["TP", 3, 0].runs_to_end_of_inning == 0
    home = fx.canonical_id(F.lit("team:source:mlb_statsapi:10"))
    assert tables["fact_plate_appearance"].where(~F.col("is_top_inning") & (F.col("batting_team_id") == home)).count() == 7


def test_run_expectancy(tables, spark):
    cells = {(r.base_state, r.outs): (r.pa_count, r.runs) for r in tables["run_expectancy_daily"].collect()}
    assert cells == {(0, 0): (2, 4), (1, 0): (1, 3), (0, 1): (1, 1), (1, 1): (1, 1), (1, 2): (1, 1), (6, 2): (1, 1), (3, 0): (1, 0)}
    days = spark.createDataFrame([(DAY1,), (DAY2,)], "dt string")
    dense = gold.run_expectancy(tables["run_expectancy_daily"], days)
    assert dense.where(F.col("dt") == DAY2).count() == 7
    assert dense.where("base_state = 0 and outs = 0").select("exp_runs").distinct().first().exp_runs == 2.0


def test_batting_metrics(tables):
    batter = tables["fact_plate_appearance"].where("event_type = 'HR'").first().batter_id
    who = [("batter_id", "eq", batter)]
    row = metric(tables, ["pa", "ab", "hits", "doubles", "triples", "home_runs", "walks", "strikeouts", "total_bases", "avg", "obp", "slg", "ops", "bb_pct", "k_pct", "runs_on_play", "re24"], where=who)[0]
    assert (row.pa, row.ab, row.hits, row.doubles, row.triples, row.home_runs, row.walks, row.strikeouts, row.total_bases) == (6, 5, 3, 1, 0, 1, 1, 1, 7)
    assert (row.avg, row.obp, row.slg, row.ops) == pytest.approx((0.6, 4 / 6, 1.4, 4 / 6 + 1.4))
    assert (row.bb_pct, row.k_pct, row.runs_on_play, row.re24) == pytest.approx((1 / 6, 1 / 6, 3, 1.0))
    re24 = {r.event_type: r.re24 for r in metric(tables, ["re24"], ["event_type"], where=who)}
    assert (re24["1B"], re24["HR"], re24["K"], re24["TRUNCATED"]) == pytest.approx((1.0, 1.0, -1.0, 0.0))
    assert metric(tables, ["pa"], where=[("batter_id", "eq", "x' OR 1=1 --")])[0].pa is None
    assert {r.team_name: r.pa for r in metric(tables, ["pa"], ["team_name"])} == {"New York": 6, "Boston": 1}


def test_team_and_pitching_metrics(tables):
    rows = {r.team_name: r for r in metric(tables, ["games_played", "wins", "losses", "ties", "win_pct", "run_differential"], ["team_name"])}
    assert (rows["New York"].games_played, rows["New York"].wins, rows["New York"].ties, rows["New York"].win_pct, rows["New York"].run_differential) == (2, 1, 1, 1.0, 3)
    star = metric(tables, ["games_played"], where=[("season_phase", "eq", "allstar")])
    assert star[0].games_played == 2
    row = metric(tables, ["outs_recorded", "ip_display", "era", "whip"])[0]
    assert (row.outs_recorded, row.ip_display) == (21, "7.0") and (row.era, row.whip) == pytest.approx((27 * 3 / 21, 3 * 8 / 21))
    row = metric(tables, ["pitches", "swings", "whiffs", "avg_velocity"])[0]
    assert (row.pitches, row.swings, row.whiffs, row.avg_velocity) == (9, 6, 2, 95.0)


def test_every_metric_by_every_dimension_plans(tables):
    for name, m in sem.METRICS.items():
        for d in sem.METRIC_VIEWS[m.view].dimensions:
            sem.compile_request(sem.MetricRequest([name], [d]), lambda v: sem.VIEWS[v](tables)).schema
    assert len(sem.METRICS) == 52


@pytest.mark.parametrize(
    "request_",
    [
        sem.MetricRequest([]), sem.MetricRequest(["nope"]), sem.MetricRequest(["pa", "era"]), sem.MetricRequest(["pa"], ["nope"]), sem.MetricRequest(["pa"], ["inning", "inning"]), sem.MetricRequest(["pa"], names={"pa": "a b"}), sem.MetricRequest(["pa"], where=[("inning", "in", [])]),
        sem.MetricRequest(["pa"], where=[("inning", "eq", None)]), sem.MetricRequest(["pa"], where=[("inning", "eq", "x")]), sem.MetricRequest(["pa"], where=[("inning", "like", 1)]), sem.MetricRequest(["pa"], groups=[("hits", "gt", 1)]), sem.MetricRequest(["pa"], order=[("hits", "asc")]), sem.MetricRequest(["pa"], days=("never", None)),
        sem.MetricRequest(["pa"], where=[("inning", "gt", 1.5)]), sem.MetricRequest(["pa"], where=[("inning", "in", [1, "one"])]), sem.MetricRequest(["pa"], where=[("game_date", "eq", 3)]), sem.MetricRequest(["pa"], where=[("inning", "eq", object())]),
    ],
)
def test_refused_requests(tables, request_):
    with pytest.raises(sem.RequestError):
        sem.compile_request(request_, lambda v: sem.VIEWS[v](tables))


def test_identity(tables):
    bridge = {(r.entity_type, r.source_id, r.dt): r for r in tables["bridge"].collect()}
    assert bridge["player", "2", DAY2].canonical_id == "MANUAL" and bridge["player", "2", DAY2].match_method == "manual"
    assert bridge["player", "1", DAY1].canonical_id == bridge["player", "1", DAY2].canonical_id
    kim = {r.source_id for r in tables["bridge"].where("source = 'kbo_api'").collect()}
    assert kim == {"30:Kim", "30:Kim#2"}
    assert tables["fact_boxscore_batting"].select("player_id").distinct().count() == 2


def test_canonical_id_matches_python(spark):
    import hashlib

    def by_hand(key):
        value = int.from_bytes(hashlib.sha256(f"{key}|s".encode()).digest()[:17], "big") >> 6
        out = ""
        for _ in range(26):
            value, rest = divmod(value, 32)
            out = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"[rest] + out
        return out

    keys = [f"key:{i}" for i in range(200)] + ["김", "é", ""]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", fx.canonical_id("k", salt="s").alias("id"))
    assert all(r.id == by_hand(r.k) for r in df.collect())


TEXT = "game_id string, inning long, top_bottom string, play_ab long, play_seq_no long, event_id string, play_player_id string, text_info_text string, raw_event_json string, dt string"


def told(n, kind, text, ab, half="1", inning=1):
    return ("g", inning, half, ab, n, str(n), f"p{ab}", text, json.dumps({"TextInfo_Bat_Text_Sec": kind}), DAY2)


def test_play_by_play_text(spark):
    lines = [
        told(1, None, "1回表 西0-0広", 0), told(2, "6", "＜1番：甲＞無死走者なし", 1), told(3, "0", "1球目 カウント1-1", 1), told(4, "1", "2球目:安打 一塁", 1), told(5, "6", "＜2番：乙＞無死一塁", 2), told(6, "1", "本塁打 西 0-2 広", 2), told(7, "6", "＜3番：丙＞無死走者なし", 3), told(8, "1", "空振り三振 1アウト", 3),
        told(9, "6", "＜4番：丁＞一死走者なし", 4), told(10, "1", "四球 一塁", 4), told(11, "6", "＜5番：戊＞一死一塁", 5), told(12, "1", "併殺 3アウト", 5), told(13, "6", "＜1番：己＞無死走者なし", 6, "2"), told(14, None, "盗塁失敗 3アウト", 6, "2"),
    ]
    bridge = spark.createDataFrame([], gold.BRIDGE)
    rows = plays.with_runs_to_end(plays.from_text(spark.createDataFrame(lines, TEXT), bridge)).orderBy("play_order").collect()
    assert [r.event_type for r in rows] == ["1B", "HR", "K", "BB", "DP", "TRUNCATED"]
    assert [r.runs_scored_on_play for r in rows] == [0, 2, 0, 0, 0, 0]
    assert [r.runs_to_end_of_inning for r in rows] == [2, 2, 0, 0, 0, 0]
    assert [r.outs_after for r in rows] == [0, 0, 1, 1, 3, 3]
    assert [r.base_state_before for r in rows] == [0, 1, 0, 0, 1, 0]


def naive_suffix(rows):
    out, total = {}, 0
    if rows and rows[-1][2] != 3:
        return {k: None for k, _, _ in rows}
    for key, runs, _ in reversed(rows):
        total = None if total is None or runs is None else total + runs
        out[key] = total
    return out


def test_suffix_sum_equals_a_loop(spark):
    rng, rows, want = random.Random(1), [], {}
    for half in range(60):
        mine = [(half * 100 + i, rng.choice([0, 0, 1, 2, None]) if rng.random() < 0.3 else 0, rng.choice([0, 1, 2])) for i in range(rng.randint(1, 9))]
        mine[-1] = (*mine[-1][:2], rng.choice([3, 3, 3, 2, None]))
        want |= naive_suffix(mine)
        rows += [("s", "g", half, True, k, runs, outs) for k, runs, outs in mine]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "source string, game_id string, inning long, is_top_inning boolean, play_order long, runs_scored_on_play long, outs_after long")
    assert {r.play_order: r.runs_to_end_of_inning for r in plays.with_runs_to_end(df).collect()} == want


def test_play_by_play_text_is_sorted_once_and_its_plate_appearances_once(spark):
    lines = spark.createDataFrame([told(1, "6", "無死走者なし", 1), told(2, "1", "空振り三振", 1)], TEXT)
    found = plays.from_text(lines, spark.createDataFrame([], gold.BRIDGE))
    assert found._jdf.queryExecution().executedPlan().toString().count("Sort [game_id") == 2
