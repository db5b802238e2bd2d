import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from infield.functions import columns as fx
from infield.operators import insights, ml, quality, relational, silver
from infield.plans import semantic as sem
from infield.sources import lake
from infield.streaming import daily

# Slowly changing dimensions -----------------------------------------------------------------------------

VERSIONS = "k string, name string, city string, note string, valid_from_dt string, valid_to_dt string, is_current boolean"


def naive_scd2(previous, today, dt, before):
    out = [r for r in previous if r["is_current"] is False]
    current = {r["k"]: r for r in previous if r["is_current"] is not False}
    for r in today:
        old = current.get(r["k"])
        same = old and (old["name"], old["city"]) == (r["name"], r["city"])
        if old and not same:
            out.append({**old, "valid_to_dt": (date.fromisoformat(dt) - timedelta(days=1)).isoformat(), "is_current": False})
        out.append({**r, "valid_from_dt": (old["valid_from_dt"] or before) if same else dt, "valid_to_dt": None, "is_current": True})
    keys = {r["k"] for r in today}
    return out + [r for k, r in current.items() if k not in keys]


def test_scd2_equals_a_loop_over_days(spark):
    rng, previous, before = random.Random(1), [], "2026-01-01"
    for n in range(2, 7):
        dt = f"2026-01-{n:02d}"
        today = [{"k": f"k{i}", "name": rng.choice(["a", "b", None]), "city": rng.choice(["x", None]), "note": str(rng.random())} for i in range(12) if rng.random() < 0.7]
        was = spark.createDataFrame([tuple(r.get(c) for c in ("k", "name", "city", "note", "valid_from_dt", "valid_to_dt", "is_current")) for r in previous], VERSIONS)
        now = spark.createDataFrame([tuple(r.values()) for r in today], "k string, name string, city string, note string")
        got = [r.asDict() for r in relational.scd2(was, now, "k", ["name", "city"], dt, before).collect()]
        previous = naive_scd2(previous, today, dt, before)
        order = lambda rows: sorted(json.dumps(r, sort_keys=True) for r in rows)
        assert order(got) == order(previous)
        before = dt


# Columns ------------------------------------------------------------------------------------------------

@pytest.mark.parametrize(("text", "outs"), [("6.2", 20), ("0.1", 1), ("9.0", 27), ("5.1", 16), ("5 2/3", 17), ("1/3", 1), ("x", None), (None, None), ("7", 21)])
def test_innings(spark, text, outs):
    df = spark.createDataFrame([(text,)], "ip string")
    assert df.select(fx.innings_to_outs("ip").alias("o")).first().o == outs


def test_event_codes(spark):
    cases = {"strikeout_double_play": "K", "sac_fly_double_play": "SF", "grounded_into_double_play": "DP", "sac_bunt_double_play": "SH", "double": "2B", "catcher_interf": "INT", "fielders_choice_out": "FC", "field_error": "ERROR", "force_out": "OUT", "truncated_pa": "TRUNCATED", "": "UNKNOWN", None: "UNKNOWN", "intent_walk": "BB"}
    df = spark.createDataFrame([(e,) for e in cases], "e string").select("e", fx.event_code("e").alias("c"))
    assert {r.e: r.c for r in df.collect()} == cases


def test_result_texts(spark):
    cases = {"スリーバントを試みるも空振り": "K", "送りバント失敗": "OUT", "3球目:送りバント成功 エラー": "SH", "送りバントの構えから安打": "1B", "スクイズ 本塁アウト": "FC", "バスター 失敗": "OUT", "併殺打": "DP", "落球": "ERROR", "打撃妨害": "INT", "？": "UNKNOWN"}
    df = spark.createDataFrame([(e,) for e in cases], "e string").select("e", fx.result_code("e").alias("c"))
    assert {r.e: r.c for r in df.collect()} == cases
    states = spark.createDataFrame([("＜1番：名＞一死一三塁",), ("＜2番：名＞無死走者なし",), ("＜3番＞二死満塁",), ("試合開始",)], "h string").select(fx.header_outs("h").alias("o"), fx.header_bases("h").alias("b")).collect()
    assert [(r.o, r.b) for r in states] == [(1, 5), (0, 0), (2, 7), (None, None)]


# Silver -------------------------------------------------------------------------------------------------

def test_mlb_feeds(spark):
    games = {"dates": [{"games": [{"gamePk": 1, "officialDate": "2026-05-01", "gameType": "R", "status": {"detailedState": "Final"}, "teams": {"home": {"score": 3, "team": {"id": 10, "name": "A"}}, "away": {"score": "x", "team": {"id": 20}}}}, {"officialDate": "2026-05-01"}]}]}
    bronze = spark.createDataFrame([("2026-05-01", json.dumps(games)), ("2026-05-02", "not json")], "dt string, body_text string")
    row = silver.mlb_games(bronze).collect()
    assert len(row) == 1 and (row[0].game_id, row[0].home_score, row[0].away_score, row[0].venue) == ("1", 3, None, None)
    box = {"gamePk": 1, "teams": {"home": {"team": {"id": 10}, "players": {"ID1": {"person": {"id": 1}, "stats": {"batting": {"atBats": 0, "plateAppearances": 1}, "pitching": {}}}, "ID2": {"person": {"id": 2}, "stats": {"batting": {"atBats": 0}, "pitching": {"inningsPitched": "1.2", "strikeOuts": 3}}}}}, "away": {"team": {"id": 20}, "players": {}}}}
    bronze = spark.createDataFrame([("2026-05-01", json.dumps(box))], "dt string, body_text string")
    assert [r.player_id for r in silver.mlb_boxscore(bronze, "batting").collect()] == ["1"]
    assert [(r.player_id, r.ip, r.so) for r in silver.mlb_boxscore(bronze, "pitching").collect()] == [("2", "1.2", 3)]


def test_pitches_keep_the_first_and_count_repeats(spark):
    rows = [("g", "1", "1", "95.1"), ("g", "1", "1", "95.1"), ("g", "1", "2", "x"), ("g", "1", "2", "94"), (None, "1", "1", "90")]
    df = spark.createDataFrame(rows, "game_pk string, at_bat_number string, pitch_number string, release_speed string").coalesce(1)
    assert sorted((r.pitch_number, r.release_speed) for r in silver.pitches(df).collect()) == [(1, 95.1), (2, None)]
    kinds = silver.pitch_repeats(df.where("game_pk is not null")).first()
    assert (kinds.identical, kinds.conflicting, kinds.extra_rows) == (1, 1, 2)


def test_records_and_rosters(spark):
    bodies = ['[{"PlayerID": 1, "StaffKind": "4", "RosterName": "投手", "TeamID": 9}]', '{"data": [{"PlayerID": 2, "StaffKind": "3", "TeamID": 9}, {"PlayerID": 2, "TeamID": 9}]}', '{"PlayerID": 3, "TeamID": 9}', "junk"]
    bronze = spark.createDataFrame([("d", b) for b in bodies], "dt string, body_text string")
    rows = {r.player_id: (r.role, r.position) for r in silver.npb_rosters(silver.records(bronze)).collect()}
    assert rows == {"1": ("player", "P"), "2": ("coach", None), "3": (None, None)}
    with pytest.raises(KeyError):
        silver.normalise("nobody", "nothing", bronze)


def test_korean_grids(spark):
    df = spark.createDataFrame([("g", "t", [["1", "Kim"], ["2", "Lee"]], [["3", "1", "2", "0"], ["0", "0", "0", "0"]], "d")], "game_id string, team_id string, names array<array<string>>, lines array<array<string>>, dt string")
    assert [(r.player_name, r.ab, r.h) for r in silver.kbo_batting(df).collect()] == [("Kim", 3, 2)]


# Lake ---------------------------------------------------------------------------------------------------

def test_days_are_replaced_and_cleared(spark, tmp_path):
    root = str(tmp_path)
    make = lambda rows: spark.createDataFrame(rows, "dt string, v long")
    lake.write_days(make([("2026-01-01", 1), ("2026-01-02", 2)]), root, "t", ["2026-01-01", "2026-01-02"])
    lake.write_days(make([("2026-01-01", 9)]), root, "t", ["2026-01-01", "2026-01-02"])
    assert [(r.dt, r.v) for r in lake.read(spark, root, "t").collect()] == [("2026-01-01", 9)]
    lake.write_days(make([("2026-01-01", 5), ("2026-01-03", 3)]), root, "t", ["2026-01-01", "2026-01-03"], force=False)
    t = lake.read(spark, root, "t")
    assert sorted((r.dt, r.v) for r in t.collect()) == [("2026-01-01", 9), ("2026-01-03", 3)]
    assert dict(t.dtypes)["dt"] == "string" and lake.newest_before(t, "2026-01-03") == "2026-01-01"
    assert lake.as_of(t).first().v == 3 and lake.read(spark, root, "none") is None
    lake.publish_range(t, root, "copy", "2026-01-01", "2026-01-02")
    assert lake.read(spark, root, "copy").count() == 1


def test_append_new_and_latest_fetch(spark, tmp_path):
    rows = spark.createDataFrame([("d", "a", "1"), ("d", "b", "2")], "dt string, response_checksum string, ingested_at_utc string")
    lake.append_new(rows, str(tmp_path), "b")
    assert lake.append_new(rows, str(tmp_path), "b").count() == 0
    assert lake.bronze(lake.read(spark, str(tmp_path), "b")).first().response_checksum == "b"
    nothing = rows.withColumn("response_checksum", F.lit(None).cast("string"))
    assert lake.bronze(nothing).count() == 2


def test_registered_tables_and_refresh(spark, tmp_path):
    lake.write_days(spark.createDataFrame([("2026-01-01", 1)], "dt string, v long"), str(tmp_path), "reg_t", ["2026-01-01"])
    assert lake.register(spark, str(tmp_path), {"reg_t": "a table", "absent": "none"}) == ["reg_t"]
    assert spark.table("reg_t").first().v == 1
    spark.sql("DROP TABLE reg_t")
    assert lake.seasons_to_refresh(["2026-02-01"], ["2025-12-31", "2026-01-31", "2026-02-01", "2026-03-01"]) == ["2026-03-01"]


def test_lossless_alignment(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "a int, b double, c double").withColumn("d", F.lit(None))
    out = lake.aligned(df, {"a": "bigint", "b": "bigint", "d": "string"})
    assert dict(out.dtypes) == {"a": "bigint", "b": "bigint", "c": "double", "d": "string"}
    for bad, target in ((2.5, "bigint"), (1e16, "bigint"), (1.0, "string")):
        with pytest.raises(ValueError):
            lake.aligned(spark.createDataFrame([(bad,)], "b double"), {"b": target})


def test_sentinels_names_and_contracts(spark):
    df = spark.createDataFrame([(None, 1), (True, None)], "empty boolean, v long")
    assert lake.without_sentinels(df).collect()[0].v == 1 and lake.without_sentinels(df).columns == ["v"]
    assert lake.publishable(spark.createDataFrame([(1, 2, [1])], "`2b` int, `c_2b` int, `x y` array<int>")).columns == ["c_2b", "c_2b_1", "x_y"]
    with pytest.raises(ValueError):
        lake.require(df, ["missing"], "t")


# Machine learning ---------------------------------------------------------------------------------------

CFG, SPLITS = ml.Breakout(min_baseline_pa=3, min_label_pa=2), ml.Splits("2025-07-15", "2025-08-15", 14)


def daily_line(player, dt, pa, value, league="MLB"):
    return (dt, player, league, pa, pa, 1, 0, 0, 0, 0, 0, 1, 0, 0, pa, value, "mlb_statcast")


def test_features_and_labels_do_not_look_ahead(spark):
    schema = "dt string, player_id string, league_code string, " + ", ".join(f"{s} long" for s in ml.STATS[:-1]) + ", woba_value double, source string"
    lines = [daily_line("a", "2025-05-30", 4, 1.0), daily_line("a", "2025-05-31", 4, 1.0), daily_line("b", "2025-05-31", 1, 1.0)]
    later = [daily_line("a", "2025-06-05", 4, 3.0)]
    days = spark.createDataFrame([((date(2025, 5, 1) + timedelta(days=n)).isoformat(),) for n in range(60)], "dt string")
    make = lambda rows, published: ml.examples(spark.createDataFrame(rows, schema), published, "2025-05-31", CFG, SPLITS).collect()
    row = make(lines + later, days)[0]
    assert (row.player_id, row.f_base_pa, row.f_day_pa, row.label_status, row.label_breakout, row.split) == ("a", 8, 4, "labeled", True, "train")
    assert row.label_woba_delta == 0.5 and row.f_league_base_woba == pytest.approx(3 / 9, abs=1e-6)
    pending = make(lines + later, days.where("dt <= '2025-06-13'"))[0]
    assert (pending.label_status, pending.label_pa) == ("pending", None)
    assert [pending[c] for c in pending.__fields__ if c.startswith("f_")] == [row[c] for c in row.__fields__ if c.startswith("f_")]
    assert make(lines, days)[0].label_status == "insufficient_pa"


def test_logistic_fit_recovers_coefficients(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 2))
    y = rng.random(4000) < 1 / (1 + np.exp(-(0.5 + x @ [1.5, -0.8])))
    df = spark.createDataFrame([(float(a), float(b), bool(c)) for (a, b), c in zip(x, y, strict=True)], "x_u double, x_v double, y boolean").repartition(4)
    model = ml.fit(df, "y", ["u", "v"], 0.1)
    slopes = [c / s for c, s in zip(model.coefficients, model.deviations, strict=True)]
    assert slopes == pytest.approx([1.5, -0.8], abs=0.15)
    result = ml.evaluate(df.withColumn("p", model.score()), "p", "y").first()
    assert result.auc > 0.75 and result.log_loss < 0.6
    chosen, tried = ml.choose(df, df, "y", ["u", "v"], [0.1, 100.0], 100, 10)
    assert len(tried) == 2 and chosen.l2 == 0.1
    with pytest.raises(ValueError):
        ml.choose(df, df, "y", ["u"], [0.1], 10_000, 10)


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.4, 1), (0.8, 1), (None, 1)], "s double, y int")
    assert relational.tied_rank_auc(df, "s", "y").first().auc == pytest.approx(0.875)


def test_split_embargo(spark):
    days = spark.createDataFrame([(d,) for d in ("2025-07-01", "2025-07-02", "2025-07-15", "2025-07-16", "2025-08-02", "2025-08-16")], "dt string")
    assert [r.s for r in days.select(ml.embargoed_split_of(F.col("dt"), SPLITS).alias("s")).collect()] == ["train", "embargo", "embargo", "validation", "embargo", "test"]
    with pytest.raises(ValueError):
        ml.Breakout(label_days=40)


# Insights, quality --------------------------------------------------------------------------------------

def test_streaks_and_changes(spark):
    schema = "dt string, player_id string, league_code string, pa long, h long, so long, bb long, hr long, woba_den long, woba_value double"
    rows = []
    for n in range(60):
        dt = (date(2026, 4, 1) + timedelta(days=n)).isoformat()
        rows.append((dt, "hot", "MLB", 4, 1 if n >= 45 else 0, 1, 1, 0, 4, 3.0 if n >= 46 else 1.0))
        rows.append((dt, "off", "NPB", 4, 1 if 30 <= n < 50 else 0, 1, 1, 0, 4, 1.0))
    df = spark.createDataFrame(rows, schema)
    empty_contact = spark.createDataFrame([], "dt string, player_id string, woba_value double, xwoba_value double, woba_den double, bip long, babip_hits long, xwoba_bip_n long")
    empty_pitches = spark.createDataFrame([], "dt string, player_id string, pitch_type string, pitches long, swings long, whiffs long, velo_sum double, velo_n long, xwoba_value double, woba_den double")
    limits = {**insights.THRESHOLDS, "cross_league_gap": {"min_season_pa": 100, "min_abs_z": 50.0}}
    found = insights.detect(df, empty_contact, empty_pitches, "2026-05-30", limits).collect()
    assert {(r.detector, r.subject_id) for r in found} == {("hitting_streak", "hot"), ("change_vs_baseline", "hot")}
    streak = next(r for r in found if r.detector == "hitting_streak")
    assert streak.value == 15 and json.loads(streak.facts_json)["end_dt"] == "2026-05-30" and len(streak.insight_id) == 20
    df.createOrReplaceTempView("feature_batter_daily")
    assert spark.sql(sem.guarded(spark, streak.evidence_sql)).count() == 15
    assert all(insights.verified(spark, r) for r in found)
    assert insights.verified(spark, streak, 15.0) and not insights.verified(spark, streak, 14.0)


def test_quality_checks(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (None, 9)], "k int, v int")
    games = spark.createDataFrame([("Postponed",), ("試合中止",)], "status string")
    results = quality.union([
        quality.uniqueness(a, "a", ["k"]), quality.referential_integrity(a, spark.createDataFrame([(1,)], "p int"), "a", "k", "p"), quality.value_range(a, "v", "v", 0, 8),
        quality.least_rows(a.limit(0), "none", 1, games), quality.least_rows(a.limit(0), "off", 1, games.limit(0)), quality.coverage(a.select("k"), a.limit(0).select("k"), "c", "k", 0.9),
    ])
    assert {r.check_name: r.status for r in results.collect()} == {"unique:a": "fail", "references:a": "pass", "range:v": "fail", "rows:none": "skip", "rows:off": "pass", "coverage:c": "skip"}
    with pytest.raises(ValueError, match="range:v, unique:a"):
        quality.enforce(results)
    assert quality.schema_changes(a, T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.LongType())]).json()) == ["+v", "-x", "~k"]


# Streaming --------------------------------------------------------------------------------------------

def test_stream_of_days(spark, tmp_path):
    rows = [(i % 5, f"2026-01-01 00:0{i % 6}:00", float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "k int, at string, v double").withColumn("at", F.to_timestamp("at"))
    df.write.parquet(str(tmp_path / "in"))
    seen = []
    stream = daily.first_of_key(daily.arrivals(spark, str(tmp_path / "in"), df.schema), ["k"], "at", "1 hour")
    daily.run_once(stream, lambda batch, n: seen.extend(batch.collect()), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.k for r in seen) == [0, 1, 2, 3, 4]


def test_days_written_from_the_table_itself(spark, tmp_path):
    root = str(tmp_path)
    lake.write_days(spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2)], "dt string, v long"), root, "own", ["2026-01-01", "2026-01-02"])
    own = lake.read(spark, root, "own")
    lake.write_days(own.where("v = 2").withColumn("v", F.col("v") * 10).drop("ingested_at_utc"), root, "own", ["2026-01-01", "2026-01-02"])
    assert [(r.dt, r.v) for r in lake.read(spark, root, "own").collect()] == [("2026-01-02", 20)]


def test_reading_leaves_the_session_alone_and_tells_absence_from_faults(spark, tmp_path):
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    was = spark.conf.get(key)
    assert lake.read(spark, str(tmp_path), "nowhere") is None
    assert spark.conf.get(key) == was
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception, match=r"(?i)footer|parquet"):
        lake.read(spark, str(tmp_path), "bad").collect()


def test_auc_equals_average_ranks_over_many_scores(spark):
    rows = [(g, ((i * 7919) % 997) / 997.0 if g else float(i % 5), (i * 31 + g) % 3 == 0) for g in (0, 1) for i in range(1_500)]
    df = spark.createDataFrame([(g, s, int(y)) for g, s, y in rows], "g long, s double, y long")

    def area(some):
        pos, neg = [s for s, y in some if y], [s for s, y in some if not y]
        return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))

    assert relational.tied_rank_auc(df, "s", "y").first().auc == pytest.approx(area([(s, y) for _, s, y in rows]))
    by = {r.g: r.auc for r in relational.tied_rank_auc(df, "s", "y", ["g"]).collect()}
    assert by == {g: pytest.approx(area([(s, y) for h, s, y in rows if h == g])) for g in (0, 1)}


def test_headers_that_repeat_or_are_uneven(spark):
    df = spark.createDataFrame([(["ERA", " IP", "ERA"], ["1", "2", "3"]), (["IP", "ERA"], ["5"]), (["IP"], ["6", "7"]), ([], []), (None, None)], "h array<string>, c array<string>")
    assert [(r.era, r.ip) for r in silver.by_header(df, "h", "c", {"era": "ERA", "ip": "IP"}).collect()] == [("3", "2"), (None, "5"), (None, "6"), (None, None), (None, None)]


def test_first_pitch_is_the_files_first_however_it_is_split(spark, tmp_path):
    rows = ["game_pk,at_bat_number,pitch_number,release_speed"] + [f"g,{i % 50},1,{i}" for i in range(4_000)]
    (tmp_path / "p.csv").write_text("\n".join(rows))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        kept = silver.pitches(lake.csv_rows(spark, str(tmp_path)))
        assert sorted(r.release_speed for r in kept.collect()) == [float(i) for i in range(50)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
