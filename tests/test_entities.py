"""Specifications of entities: one sample response each, stages by league, work lists, and small helpers of the service."""

import json

import pytest
from pyspark.sql import functions as F

from infield.operators import entities as en
from infield.operators import gold
from infield.plans import semantic as sem

SAMPLE = {"a": 1, "PlayerID": "7", "PlayerName": "P", "TeamID": 3, "TeamName": "T", "Win": 0, "Lose": "5", "Tie": None, "WinRate": ".000", "GameBehind": "-", "GameID": "g", "GameDate": "20260501", "GameTime": "1800", "HomeTeamID": 1, "VisitorTeamID": 2, "HomeScore": "4", "VisitorScore": 0}


def responses(e):
    """A list, a list under each key, a single object, and junk."""
    texts = [json.dumps([SAMPLE, "no object"]), *[json.dumps({k: [SAMPLE, SAMPLE]}) for k in e.lists], json.dumps(SAMPLE), "<html>", "", "{broken", "[1, 2]", None]
    n = 1 + 2 * len(e.lists) + 1
    if e.per is None:
        return [("2026-05-01", t) for t in texts], n
    batch = [{e.id_column: str(i), "body_text": t, "status_code": 200} for i, t in enumerate(texts)]
    return [("2026-05-01", json.dumps({f"{e.per}s": batch})), ("2026-05-01", "junk"), ("2026-05-01", "{}")], n


def test_there_are_28_entities():
    assert len({e.name for e in en.NPB}) == len(en.NPB) == 28


@pytest.mark.parametrize("name", [e.name for e in en.NPB])
def test_every_shape_of_response(spark, name):
    e = en.by_name(en.NPB, name)
    rows, n = responses(e)
    df = spark.createDataFrame(rows, "dt string, body_text string")
    found = en.records(e, df).collect()
    assert len(found) == n and all(json.loads(r.raw_json) == SAMPLE for r in found)
    out = en.normalised(e, df)
    assert set(out.columns) == {"dt", "raw_json", *e.columns, *([e.id_column] if e.per else [])}
    kept = out.collect()
    assert len(kept) == (len({r[e.id_column] for r in found}) if e.keys else n)


def test_typed_columns(spark):
    df = spark.createDataFrame([("2026-05-02", json.dumps([SAMPLE, {"team_id": "x", "t": 2}]))], "dt string, body_text string")
    a, b = en.normalised(en.by_name(en.NPB, "standings"), df).orderBy("team_id").collect()
    assert (a.team_id, a.team_name, a.w, a.l, a.t, a.pct, a.gb) == ("3", "T", 0, 5, None, ".000", "-") and (b.team_id, b.w, b.t) == ("x", None, 2)
    g = en.normalised(en.by_name(en.NPB, "games"), df).where("game_id = 'g'").first()
    assert (g.game_date, g.game_time, g.home_team_id, g.home_score, g.away_score) == ("2026-05-01", "18:00", "1", 4, 0)
    with pytest.raises(KeyError):
        en.by_name(en.NPB, "nothing")


def test_periods_and_work_lists(spark):
    days = spark.createDataFrame([("2026-05-01",), ("2026-05-31",), ("2026-06-01",), ("2025-12-31",)], "dt string")
    got = lambda name: sorted(r.dt for r in en.periods_of(en.by_name(en.NPB, name), days).collect())
    assert got("monthly_schedule") == ["2025-12-01", "2026-05-01", "2026-06-01"] and got("rosters") == ["2025-01-01", "2026-01-01"] and len(got("games")) == 4 and got("weekly_schedule") == ["2025-12-29", "2026-04-27", "2026-05-25", "2026-06-01"]
    raw = spark.createDataFrame([("d", '{"TeamID": 1}')] * 50 + [("d", '{"id": "2"}'), ("e", '{"TeamID": 1}'), ("e", "{}"), ("e", "junk")], "dt string, raw_json string")
    assert sorted(map(tuple, en.fan_out(en.by_name(en.NPB, "rosters"), raw, ["TeamID", "id"]).collect())) == [("d", "1"), ("d", "2"), ("e", "1")]
    with pytest.raises(ValueError):
        en.fan_out(en.by_name(en.NPB, "games"), raw, ["id"])


def test_stages_by_league():
    assert ("games", "npb_spaia", "games") in en.planned(["games"], ["NPB"]) and len(en.planned(["games"], ["NPB"])) == 1
    assert ("pbp", "retrosheet_local", "plays") in en.planned(["pbp"], ["mlb"]) and len(en.planned()) == sum(map(len, en.STAGES.values()))
    assert en.planned(["player_bios"], ["kbo"]) == []
    with pytest.raises(KeyError):
        en.planned(["nothing"])


def test_transactions_and_unlisted_players(spark):
    moves = spark.createDataFrame([("1", "10", "7", "Trade", "2026-05-01", "x", "2026-05-01")] * 2 + [("2", None, "8", None, None, None, "2026-05-01")], "transaction_id string, team_id string, player_id string, type_desc string, date string, description string, dt string")
    bridge = spark.createDataFrame([("player", "mlb_statsapi", "7", "P7"), ("team", "mlb_statsapi", "10", "T10")], gold.BRIDGE)
    rows = sorted(gold.fact_transaction(moves, bridge).collect(), key=lambda r: r.transaction_type or "")
    assert len(rows) == 2 and (rows[1].team_id, rows[1].player_id, rows[1].transaction_type, rows[1].effective_dt) == ("T10", "P7", "Trade", "2026-05-01") and rows[0].team_id is None and len(rows[0].player_id) == 26
    season = spark.createDataFrame([("d", "1", "a"), ("d", "1", "b"), ("d", "2", "c"), ("e", "2", "c"), ("d", None, "x")], "dt string, player_id string, player_name string")
    assert sorted(map(tuple, en.unlisted(season, season.where("dt = 'd' and player_id = '2'")).collect())) == [("d", "1", "a"), ("e", "2", "c")]


def test_rows_as_the_service_gives_them(spark):
    df = spark.createDataFrame([("MLB", 2, 2026), ("MLB", None, 2026), (None, 1, 2026), ("MLB", 1, 2025)], "league_code string, rank int, season_year int")
    assert [(r.league_code, r["rank"]) for r in sem.ranked_rows(df).collect()] == [(None, 1), ("MLB", 1), ("MLB", 2), ("MLB", None)]
    assert [r["rank"] for r in sem.ranked_rows(df, "mlb", 2026).collect()] == [2, None]
    odd = spark.sql("SELECT 1 / 3D AS d, date'2026-05-01' AS day, array(1, 2) AS a, true AS b, 'x' AS `a.b`, CAST(null AS double) AS n, 2.50BD AS m")
    assert tuple(sem.json_safe(odd).first()) == (0.333333, "2026-05-01", "[1, 2]", True, "x", None, "2.50")
    t = sem.stand_ins({"a": df}, {"a": "x int", "feature_pitch_daily": "dt string, pitches long"}, spark)
    assert t["a"] is df and t["feature_pitch_daily"].agg(F.sum("pitches")).first()[0] is None
    assert sem.described("a  text\n here", "dim_team.team_id") == "a text here FK to dim_team.team_id." and sem.described("of dim_team", "dim_team.team_id") == "of dim_team" and len(sem.described("x" * 2000)) == 1024
    assert sem.restored_names(spark.sql("SELECT 1 AS c_2b, 2 AS c_x, 3 AS c_3b")).columns == ["2b", "c_x", "3b"]
