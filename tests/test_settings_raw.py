"""Settings from files, overrides, and raw responses by checksum."""

import json

import pytest

from infield.operators import gold, insights
from infield.operators.ml import Breakout
from infield.plans import semantic as sem
from infield.sources import lake, settings


def put(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value))
    return str(path)


def test_settings_of_the_model_and_the_detectors(spark, tmp_path):
    found = settings.load(spark, put(tmp_path / "s.json", {"breakout": {"baseline_days": 40, "margin_woba": 1, "sources": ["mlb_statcast"]}, "splits": {"train_end": "2026-05-01", "validation_end": "2026-06-01", "embargo_days": 14}, "insights": {"luck_gap": {"min_pa": 50}, "hitting_streak": {}}}))
    cfg = settings.breakout(found["breakout"])
    assert (cfg.baseline_days, cfg.recent_days, cfg.sources) == (40, 7, ("mlb_statcast",)) and cfg.version != Breakout().version
    assert settings.splits(found["splits"]).embargo_days == 14
    limits = settings.thresholds(found["insights"])
    assert list(limits) == ["luck_gap", "hitting_streak"] and limits["luck_gap"] == {**insights.THRESHOLDS["luck_gap"], "min_pa": 50} and limits["hitting_streak"] == insights.THRESHOLDS["hitting_streak"]


@pytest.mark.parametrize(("make", "given"), [
    (settings.breakout, {"basline_days": 3}), (settings.breakout, {"baseline_days": "30"}), (settings.breakout, {"label_days": 40}), (settings.breakout, {"recent_days": True}), (settings.thresholds, {"nothing": {}}), (settings.thresholds, {"luck_gap": {"min_pas": 1}}), (settings.thresholds, {"luck_gap": {"min_pa": None}}),
    (settings.splits, {"train_end": "2026-05-01"}), (settings.splits, {"train_end": "2026-05-01", "validation_end": "2026-04-01", "embargo_days": 1}),
])
def test_settings_that_are_refused(make, given):
    with pytest.raises(settings.SettingsError):
        make(given)


def test_files_that_are_no_settings(spark, tmp_path):
    for text in ("{", "[1]"):
        with pytest.raises(settings.SettingsError):
            settings.load(spark, put(tmp_path / "x.json", text))


def test_overrides_reach_the_bridge(spark, tmp_path):
    path = put(tmp_path / "o.csv", "entity_type,source,source_id,canonical_id,notes\nplayer,mlb_statsapi, 7 ,HAND,why\nplayer,mlb_statsapi,8,,\nplayer,mlb_statsapi,7,GIVEN,old\n")
    given = settings.overrides(spark, path)
    assert [tuple(r) for r in given.collect()] == [("player", "mlb_statsapi", "7", "HAND", "why")]
    rosters = spark.createDataFrame([("2026-05-01", "7", "A", "1"), ("2026-05-01", "8", "B", "1")], "dt string, player_id string, player_name string, team_id string")
    bridge = {r.source_id: r for r in gold.resolve(gold.collected({("mlb_statsapi", "rosters"): rosters}), given).collect()}
    assert bridge["7"].canonical_id == "HAND" and bridge["7"].match_method == "manual" and bridge["8"].match_method == "exact_id"
    days = rosters.select("dt")
    assert [(r.source_id, r.notes, r.dt) for r in gold.merge_events(given, days).collect()] == [("7", "why", "2026-05-01")]
    assert settings.overrides(spark, str(tmp_path / "none.csv")) is None
    with pytest.raises(settings.SettingsError):
        settings.overrides(spark, put(tmp_path / "bad.csv", "a,b\n1,2\n"))


def test_raw_responses_are_kept_once(spark, tmp_path):
    make = lambda *rows: spark.createDataFrame([("npb_spaia", "games", d, "u", 200, at, body) for d, at, body in rows], "source string, entity string, dt string, url string, status_code int, fetched_at_utc string, body_text string")
    root = str(tmp_path)
    assert lake.raw(spark, root) is None
    first = make(("2026-05-01", "t1", '{"a": 1}'), ("2026-05-01", "t2", '{"a": 1}'), ("2026-05-02", "t1", '{"a": 1}'), ("2026-05-01", "t3", None))
    assert lake.write_raw(first, root).first().written == 3
    assert lake.write_raw(make(("2026-05-01", "t9", '{"a": 1}'), ("2026-05-01", "t9", '{"a": 2}')), root).first().written == 1
    rows = lake.raw(spark, root, "npb_spaia", "games").collect()
    assert sorted((r.dt, r.fetched_at_utc, r.body_text) for r in rows if r.body_text) == [("2026-05-01", "t1", '{"a": 1}'), ("2026-05-01", "t9", '{"a": 2}'), ("2026-05-02", "t1", '{"a": 1}')]
    assert list(tmp_path.rglob("*.json.gz")) and lake.raw(spark, root, "other").count() == 0
    assert lake.write_raw(make(("2026-05-01", "t9", '{"a": 2}')), root, force=True).first().written == 1


def test_every_view_and_metric_builds_on_derived_tables(spark):
    from pathlib import Path

    from infield import gold_queries

    data = "/root/testdata/sf0.001"
    if not Path(data).exists():
        pytest.skip("no test data")
    tables = gold_queries.gold_tables(spark, data)
    for name in sem.VIEWS:
        if name != "v_re_training":
            assert sem.VIEWS[name](tables).columns
    views = {name: make(tables) for name, make in sem.VIEWS.items() if name != "v_re_training"}
    for mv, view in sem.METRIC_VIEWS.items():
        measures, by = [n for n, m in sem.METRICS.items() if m.view == mv], list(view.dimensions)
        assert sem.compile_request(sem.MetricRequest(measures, by), views.__getitem__).columns == [*by, *measures]
