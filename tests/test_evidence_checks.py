"""Batch evidence, finding checks and compiled lakehouse checks, against loops."""

import json
import random
from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from infield import queries
from infield.operators import evidence, insights
from infield.plans import checks as ck


def day(n, start=date(2026, 4, 1)):
    return (start + timedelta(days=n)).isoformat()


BATTER = "dt string, player_id string, league_code string, pa long, h long, so long, bb long, hr long, woba_den long, woba_value double"
CONTACT = "dt string, player_id string, woba_value double, xwoba_value double, woba_den double, bip long, babip_hits long, xwoba_bip_n long"
PITCH = "dt string, player_id string, pitch_type string, pitches long, swings long, whiffs long, velo_sum double, velo_n long, xwoba_value double, woba_den double"


@pytest.fixture(scope="module")
def season(spark):
    r = random.Random(1)
    batter, contact, pitch = [], [], []
    for n in range(60):
        for p, lg in (("hot", "MLB"), ("cold", "MLB"), ("hot", "NPB"), ("far", "NPB")):
            late = n >= 46
            batter.append((day(n), p, lg, 4, 1 if p == "hot" and n >= 44 or r.random() < 0.4 else 0, 1 if lg == "MLB" else 3, 1, 0, 4, 3.0 if p == "hot" and late and lg == "MLB" else 1.0))
        contact.append((day(n), "hot", 2.0, 1.0, 4.0, 3, 1, 2))
        for kind, early, late, speed in (("FF", 20, 14, 92.0), ("ST", 0, 8, 84.0), ("SI", 10, 10, 91.0)):
            k = late if n >= 30 else early
            pitch.append((day(n), "arm", kind, k, k, k // 2 if n >= 30 else k // 4, k * (speed + (2.5 if kind == "FF" and n >= 30 else 0.0)), k, 0.2 * k if n < 30 else 0.1 * k, float(k)))
    return {evidence.BATTER: spark.createDataFrame(batter, BATTER), evidence.CONTACT: spark.createDataFrame(contact, CONTACT), evidence.PITCH: spark.createDataFrame(pitch, PITCH)}


@pytest.fixture(scope="module")
def candidates(season):
    limits = {**insights.THRESHOLDS, "cross_league_gap": {"min_season_pa": 100, "min_abs_z": 3.0}, "league_month_shift": {"min_month_pa": 50, "min_abs_z": 0.0}, "luck_gap": {"min_pa": 50, "min_abs_gap": 0.04}, "velocity_change": {"recent_days": 30, "pitch_types": ["FF", "SI"], "min_pitches": 100, "min_abs_mph": 1.5}}
    limits["new_pitch"] = {**insights.THRESHOLDS["new_pitch"], "min_early_pitches": 100, "min_recent_pitches": 100}
    return insights.detect(season[evidence.BATTER], season[evidence.CONTACT], season[evidence.PITCH], "2026-05-30", limits).persist()


def test_every_detector_s_evidence_gives_its_numbers_again(season, candidates):
    kinds = {r.detector for r in candidates.select("detector").distinct().collect()}
    assert kinds == set(insights.THRESHOLDS)
    rows = evidence.verified(candidates, season).collect()
    assert rows and all(r.verified and r.checks == 2 and r.wrong == 0 for r in rows)


def test_wrong_numbers_broken_streaks_and_false_claims_are_refused(spark, season, candidates):
    off = candidates.where("detector = 'luck_gap'").withColumn("evidence", F.transform("evidence", lambda p: p.withField("expected", p["expected"] + 0.001)))
    assert [r.wrong for r in evidence.verified(off, season).collect()] == [2]
    near = candidates.where("detector = 'luck_gap'").withColumn("evidence", F.transform("evidence", lambda p: p.withField("expected", p["expected"] + 0.0004)))
    assert all(r.verified for r in evidence.verified(near, season).collect())
    gone = {**season, evidence.BATTER: season[evidence.BATTER].where("dt <> '2026-05-29'")}
    refused = candidates.join(evidence.verified(candidates, gone), "insight_id").where("not verified").select("detector").distinct()
    assert {"hitting_streak"} <= {r.detector for r in refused.collect()}
    streak = candidates.where("detector = 'hitting_streak'").first()
    claims = lambda x: spark.createDataFrame([(streak.insight_id, x)], "insight_id string, claim double")
    ok = lambda x: {r.insight_id: r.verified for r in evidence.verified(candidates, season, claims(x)).collect()}[streak.insight_id]
    assert ok(streak.value) and not ok(streak.value - 1)
    none = candidates.limit(1).withColumn("evidence", F.slice("evidence", 1, 0))
    assert [(r.checks, r.verified) for r in evidence.verified(none, season).collect()] == [(0, False)]
    assert evidence.verified(candidates.limit(0), season).count() == 0


def test_posts(spark, season, candidates):
    players = spark.createDataFrame([("hot", "Ann Hot"), ("hot", "A. Hot"), ("arm", "Bo Arm"), ("cold", None)], "player_id string, primary_name string")
    known = evidence.named(candidates, players)
    by = {(r.detector, r.subject_id, r.league_code): r for r in known.collect()}
    assert by["luck_gap", "hot", "MLB"].subject_name == "Ann Hot"
    streak = next(r for k, r in by.items() if k[0] == "hitting_streak" and k[1] == "hot")
    luck, velo = by["luck_gap", "hot", "MLB"], next(r for k, r in by.items() if k[0] == "velocity_change")
    checked = evidence.verified(candidates, season)
    posts = {
        "good": (f"Ann Hot has hit in {int(streak.value)} straight games.", ["Ann Hot"], [streak.insight_id]), "percent": ("Ann Hot: 50% on, 25.0 expected, a gap of .25", ["Ann Hot"], [luck.insight_id]), "number": ("Ann Hot stands at .612", ["Ann Hot"], [luck.insight_id]),
        "names": ("Ann Hot and Zed", ["Ann Hot", "Zed", "Cy"], [luck.insight_id]), "none": ("Ann Hot", [], []), "unknown": ("x", [], ["nope"]), "tags": ("#x", [], [luck.insight_id]), "long": ("x" * 300, [], [luck.insight_id]), "best": ("Ann Hot has the best luck", ["Ann Hot"], [luck.insight_id]),
        "season": ("Ann Hot this season", ["Ann Hot"], [luck.insight_id]), "taken": ("Bo Arm throws harder", ["Bo Arm"], [velo.insight_id]), "nulls": (None, None, None),
    }
    df = spark.createDataFrame([(k, *v) for k, v in posts.items()], "finding_id string, post string, subjects array<string>, cites array<string>")
    found = {r.finding_id: r.problems for r in evidence.check_findings(df, known, checked, taken=["Bo Arm", "MLB"], since="2026-04-10").collect()}
    assert found["good"] == [] and found["percent"] == []
    assert found["number"] == ["number not in the evidence: .612"] and found["unknown"] == ["unknown evidence: nope"] and found["tags"] == ["no hashtags"] and found["long"] == ["300 characters; the limit is 280"]
    assert set(found["names"]) == {"subject not in the evidence: Zed", "subject not in the evidence: Cy", "subject not named: Cy"} and "cites nothing" in found["none"] and "cites nothing" in found["nulls"]
    assert found["season"] == ["says season, but the data begin 2026-04-10"] and found["taken"] == ["already covered: Bo Arm"]
    assert found["best"] == ([] if luck["rank"] == 1 else ["a ranking word needs a first rank: best"])
    late = evidence.check_findings(df.where("finding_id = 'best'"), known.withColumn("rank", F.lit(2)), checked).first()
    assert late.problems == ["a ranking word needs a first rank: best"]
    wrong = checked.withColumn("verified", F.lit(False))
    assert evidence.check_findings(df.where("finding_id = 'good'"), known, wrong).first().problems == [f"evidence that doesn't hold: {streak.insight_id}"]


# Compiled checks ----------------------------------------------------------------------------------------

def lake_tables(spark):
    games = [(day(0), "g1", "mlb_statsapi", "Final"), (day(0), "g1", "mlb_statsapi", "Final"), (day(1), "g2", "npb_spaia", "Game Over"), (day(2), "g3", "mlb_statsapi", "Postponed"), (day(20), "g4", "mlb_statsapi", "Final")]
    pas = [(day(0), f"a{i}", "mlb_statcast", "K", "t", "u") for i in range(150)] + [(day(0), "a1", "mlb_statcast", "TRUNCATED", None, "u")] + [(day(1), f"n{i}", "npb_spaia", "1B", "t", "u") for i in range(40)]
    return {
        "fact_game": spark.createDataFrame(games, "dt string, game_id string, source string, status string"), "fact_plate_appearance": spark.createDataFrame(pas, "dt string, pa_id string, source string, event_type string, batting_team_id string, fielding_team_id string"),
        "silver_boxscore_batting": spark.createDataFrame([(day(1), "g2"), (day(3), "g9"), (day(5), None)], "dt string, game_id string"), "silver_games": spark.createDataFrame([(day(1), "g2"), (day(3), None)], "dt string, game_id string"),
    }


def test_lakehouse_checks(spark):
    rows = ck.lakehouse(lake_tables(spark), day(0), day(30), [ck.season_covered(day(0), day(25), day(30))]).collect()
    status = {(r.dt, r.check_name): (r.status, r.value) for r in rows}
    assert status[day(0), "one row a game"] == ("fail", 1.0) and status[day(1), "one row a game"] == ("pass", 0.0)
    assert status[day(0), "plate appearances a game"] == ("pass", 75.0) and status[day(1), "NPB plate appearances a game"] == ("fail", 40.0) and status[day(2), "plate appearances a game"][0] == "skip"
    assert status[day(0), "one row a plate appearance"] == ("fail", 1.0) and status[day(0), "plate appearances with teams"] == ("fail", 1.0)
    assert [status[day(n), "box scores without games"][0] for n in (0, 1, 3, 5)] == ["skip", "pass", "fail", "skip"]
    assert status[day(20), "games without plate appearances"][0] == "fail" and status[None, "days with games"] == ("pass", 4.0) and status[None, "season covered"][0] == "fail" and status[None, "gaps of more than a week"][1] == 15.0
    assert len([r for r in rows if r.dt is None]) == 3 and len({r.check_name for r in rows}) == 17


def test_a_scan_a_table(spark, tmp_path):
    tables = {}
    for name, df in lake_tables(spark).items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    daily = ck.by_day(tables, ck.LAKEHOUSE_MEASURES, day(0), day(30))
    assert daily._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == len(tables)
    assert daily.count() == 6


def test_bad_declarations(spark):
    with pytest.raises(ValueError):
        ck.by_day({}, [ck.Measure("a", "t")], day(0), day(1))
    with pytest.raises(ValueError):
        ck.by_day(lake_tables(spark), [ck.Measure("a", "fact_game"), ck.Measure("a", "fact_game")], day(0), day(1))
    with pytest.raises(ValueError):
        ck.run(spark.createDataFrame([("d", 1)], "dt string, a int"), [ck.Check("x", "a", "a > 0"), ck.Check("x", "a", "a > 1")])


def test_silver_audit(spark):
    df = spark.createDataFrame([(day(0), "a", "x"), (day(0), "a", ""), (day(1), "a", "[]"), (day(1), None, None)], "dt string, k string, v string")
    found = {(r.table_name, r.measure): r.value for r in ck.silver_audit({"t": (df, ["k"], ["k", "v"]), "e": (df.limit(0), ["k"], ["v"])}).collect()}
    assert found["t", "days"] == 2 and found["t", "rows"] == 4 and found["t", "repeated"] == 1 and found["t", "null:v"] == 0.75 and found["t", "null:k"] == 0.25 and found["t", "last_dt"] - found["t", "first_dt"] == 1
    assert found["e", "rows"] == 0 and found["e", "null:v"] is None and json.dumps(found["e", "days"]) == "0.0"


def test_finding_checks_equal_the_sql_for_unnamed_players_and_small_values(spark, tmp_path):
    rows = []
    for player in range(8):  # players 4 to 7 are no customers; the newer days' values are below a thousandth
        rows += [f"({player * 100 + n}, TIMESTAMP '2024-01-{'05' if n < 20 else '20'} 12:00:00', {player}, 'click', {90.0 + n if n < 20 else 0.03 + 0.01 * player}, '')" for n in range(40)]
    con = duckdb.connect()
    con.sql(f"CREATE TABLE events AS SELECT event_id, ts, user_id, event_type, CAST(value AS DOUBLE) AS value, props FROM (VALUES {', '.join(rows)}) v(event_id, ts, user_id, event_type, value, props)")
    con.sql("CREATE TABLE customer AS SELECT i AS c_custkey, 'Customer#' || i AS c_name FROM range(4) r(i)")
    for name in ("events", "customer"):
        con.sql(f"COPY {name} TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    want = con.execute(queries.oracle_sql()["I11_finding_checks"]).fetchall()
    found = queries.queries()["I11_finding_checks"](spark, str(tmp_path)).collect()
    assert len(want) == 8 and sorted((r.subject_id, r.subject_name, r.problems) for r in found) == sorted(want, key=lambda x: x[0])
