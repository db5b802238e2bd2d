"""Pitch components, feature tables and drivers against plain loops over pitches."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from infield.operators import drivers as dr
from infield.operators import pitch_features as pf

SCHEMA = "game_pk string, dt string, pitcher_id string, batter_id string, pitch_type string, description string, events string, release_speed double, raw_json string"


def number(x):
    try:
        return None if x in (None, "", "null") else float(x)
    except ValueError:
        return None


def one(p):
    """What a pitch adds, by hand."""
    try:
        raw = json.loads(p[8])
    except (TypeError, ValueError):
        raw = {}
    what, kind = p[5] or raw.get("description") or "", raw.get("bb_type") or ""
    zone, den, woba, x = (number(raw.get(c)) for c in ("zone", "woba_denom", "woba_value", "estimated_woba_using_speedangle"))
    inside, outside = zone is not None and 1 <= zone <= 9, zone is not None and zone >= 11
    swing, miss, play = what in pf.FEATURE_SWINGS, what in ("swinging_strike", "swinging_strike_blocked", "missed_bunt"), what == "hit_into_play" or kind != ""
    ev, la = (number(raw.get(c)) if play else None for c in ("launch_speed", "launch_angle"))
    hx, hy = number(raw.get("hc_x")), number(raw.get("hc_y"))
    angle = math.degrees(math.atan2(hx - 125.42, 198.27 - hy)) if play and hx is not None and hy is not None else None
    pulled = angle is not None and (angle < -15 if (raw.get("stand") or "R") == "R" else angle > 15)
    out = {
        "pitches": 1, "swings": swing, "whiffs": miss, "zone_pitches": inside, "zone_swings": inside and swing, "zone_whiffs": inside and miss, "chase_pitches": outside, "chase_swings": outside and swing, "bip": play, "hard_hit": ev is not None and ev >= 95,
        "barrels": play and number(raw.get("launch_speed_angle")) == 6, "ev_sum": ev or 0.0, "ev_n": ev is not None, "la_sum": la or 0.0, "la_n": la is not None, "gb": kind == "ground_ball", "ld": kind == "line_drive", "fb": kind == "fly_ball", "pu": kind == "popup",
        "pulled": pulled, "pulled_air": pulled and kind in ("line_drive", "fly_ball"), "woba_value": (woba or 0.0) if den else 0.0, "xwoba_value": (x if x is not None else woba or 0.0) if den else 0.0, "woba_den": int(den or 0),
    }
    velo, spin = p[7] if p[7] is not None else number(raw.get("release_speed")), number(raw.get("release_spin_rate"))
    park = play and (p[6] or raw.get("events")) != "home_run"
    out |= {"velo_sum": velo or 0.0, "velo_n": velo is not None, "spin_sum": spin or 0.0, "spin_n": spin is not None, "xwoba_bip_n": play and x is not None, "balls_in_park": park, "babip_hits": park and (number(raw.get("babip_value")) or 0) > 0}
    return p[4] or raw.get("pitch_type") or "", {k: float(v) for k, v in out.items()}


def drawn(n, seed=5):
    r = random.Random(seed)
    maybe = lambda v: r.choice([v, v, v, None, "", "null", "x"])
    out = []
    for _ in range(n):
        raw = {"zone": maybe(r.randint(1, 14)), "woba_denom": r.choice(["1", "0", 1, None, "1.0"]), "woba_value": maybe(r.choice([0, 0.9, "2.0"])), "estimated_woba_using_speedangle": maybe(str(r.random())), "launch_speed": maybe(r.uniform(60, 115)), "launch_angle": maybe(str(r.uniform(-60, 60)))}
        raw |= {"launch_speed_angle": maybe(r.randint(1, 6)), "hc_x": maybe(r.uniform(0, 250)), "hc_y": maybe(r.uniform(0, 190)), "stand": r.choice(["R", "L", "", None, "S"]), "bb_type": r.choice(["ground_ball", "line_drive", "fly_ball", "popup", "", None]), "babip_value": maybe("1"), "release_speed": maybe("91.5"), "release_spin_rate": maybe(2200)}
        raw |= {"description": r.choice(["foul", "hit_into_play", None]), "pitch_type": r.choice(["SL", None]), "events": r.choice(["home_run", "single", None])}
        text = r.choice([json.dumps({k: v for k, v in raw.items() if r.random() < 0.9})] * 9 + [None, "{broken", ""])
        out.append((r.choice(["g", "g", "g", "g", ""]), f"2026-05-0{r.randint(1, 3)}", r.choice(["p1", "p2", None, ""]), r.choice(["b1", "b2", None]), r.choice(["FF", "SL", "CH", "ZZ", "", None]), r.choice([*pf.FEATURE_SWINGS, "ball", "hit_into_play", "hit_into_play_score", "", None]), r.choice(["home_run", "single", "", None]), r.choice([88.0, None]), text))
    return out


def test_components_equal_a_loop(spark):
    rows = drawn(1_500)
    tables = {k: v.collect() for k, v in pf.feature_tables(pf.pitch_components(spark.createDataFrame(rows, SCHEMA))).items()}
    group = lambda t: next((g for g, types in pf.GROUPS.items() if t in types), "other")
    want = {k: {} for k in tables}
    for p in rows:
        if not p[0]:
            continue
        kind, parts = one(p)
        keys = {"feature_pitch_daily": (p[1], p[2], kind) if p[2] and kind else None, "feature_batter_pitch_daily": (p[1], p[3], group(kind)) if p[3] and kind else None, "feature_contact_daily": (p[1], p[3]) if p[3] and parts["woba_den"] else None}
        for name, key in keys.items():
            if key:
                own = want[name].setdefault(key, dict.fromkeys(parts, 0.0))
                for k, v in parts.items():
                    own[k] += v
    for name, found in tables.items():
        assert len(found) == len(want[name]) > 5
        for r in found:
            key = tuple(r[c] for c in {"feature_pitch_daily": ("dt", "player_id", "pitch_type"), "feature_batter_pitch_daily": ("dt", "player_id", "pitch_group"), "feature_contact_daily": ("dt", "player_id")}[name])
            for c in set(r.asDict()) - {"dt", "player_id", "pitch_type", "pitch_group", "league_code", "source"}:
                part = "balls_in_park" if (name, c) == ("feature_contact_daily", "bip") else c
                assert r[c] == pytest.approx(want[name][key][part], abs=1e-5), (name, key, c)
            assert (r.league_code, r.source) == ("MLB", "mlb_statcast")
    assert [c for c in tables["feature_batter_pitch_daily"][0].asDict() if c in dr.SUMS] == [c.name for c in pf.COMPONENTS] and len(pf.COMPONENTS) == 24


def test_one_projection_reads_the_raw_record_once(spark):
    df = pf.feature_tables(pf.pitch_components(spark.createDataFrame(drawn(5), SCHEMA)))["feature_batter_pitch_daily"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def season(**changes):
    base = {c: 0.0 for c in dr.SUMS} | {"pitches": 400.0, "chase_pitches": 200.0, "chase_swings": 60.0, "zone_pitches": 200.0, "zone_swings": 140.0, "swings": 200.0, "whiffs": 50.0, "bip": 60.0, "hard_hit": 20.0, "gb": 30.0, "ev_n": 60.0, "ev_sum": 60 * 88.0, "la_n": 10.0, "la_sum": 100.0, "woba_den": 80.0, "xwoba_value": 25.6}
    return base | changes


def plain(a, b):
    out = []
    for i, s in enumerate(dr.STATISTICS):
        if min(a[s.bottom], b[s.bottom]) >= s.least:
            pa, pb = a[s.top] / a[s.bottom], b[s.top] / b[s.bottom]
            p = (a[s.top] + b[s.top]) / (a[s.bottom] + b[s.bottom])
            sd = math.sqrt(max(p * (1 - p), 1e-9)) if s.kind == dr.PROPORTION else s.spread
            out.append((s.name, round(pa, s.places), round(pb, s.places), round((pa - pb) / (sd * math.sqrt(1 / a[s.bottom] + 1 / b[s.bottom])), 2), i))
    return out


def test_statistics_of_both_kinds_and_their_least_sizes(spark):
    pairs = [(season(chase_swings=20.0, ev_sum=60 * 96.0), season()), (season(bip=24.0), season()), (season(woba_den=0.0), season(swings=0.0, whiffs=0.0)), (season(), season())]
    rows = spark.createDataFrame([(i, *[a[c] for c in dr.SUMS], *[b[c] for c in dr.SUMS]) for i, (a, b) in enumerate(pairs)], "k long, " + ", ".join(f"since_{c} double" for c in dr.SUMS) + ", " + ", ".join(f"before_{c} double" for c in dr.SUMS))
    found = {}
    for r in dr.compared(rows, ["k"]).collect():
        found.setdefault(r.k, []).append((r.metric, r.since, r.before, r.z, r.nth))
    for i, (a, b) in enumerate(pairs):
        assert sorted(found[i]) == [(m, pytest.approx(x, abs=1e-9), pytest.approx(y, abs=1e-9), pytest.approx(z, abs=0.011), n) for m, x, y, z, n in sorted(plain(a, b))]
    assert not {"avg_launch_angle"} & {m for ms in found.values() for m, *_ in ms}  # ten of them are too few
    top = dr.clearest(dr.compared(rows, ["k"]), ["k"]).where("k = 0").orderBy("rank").collect()
    assert [r.metric for r in top] == ["chase_rate", "avg_exit_velo"] and top[0].z < 0 < top[1].z


def features(spark, key, rows):
    schema = f"dt string, player_id string, {key} string, " + ", ".join(f"{c} double" for c in dr.SUMS)
    return spark.createDataFrame([(dt, p, k, *[s[c] for c in dr.SUMS]) for dt, p, k, s in rows], schema)


def test_drivers_are_attached_to_candidates(spark):
    batters = features(spark, "pitch_group", [
        ("2026-05-01", "hot", "fastball", season()), ("2026-06-20", "hot", "fastball", season(chase_swings=10.0)), ("2026-06-21", "hot", "other", season(whiffs=0.0)), ("2026-05-01", "all", "fastball", season(bip=600.0, hard_hit=60.0, gb=300.0)), ("2025-05-01", "hot", "fastball", season(chase_swings=200.0)),
    ])
    pitchers = features(spark, "pitch_type", [("2026-05-01", "arm", "FF", season()), ("2026-06-20", "arm", "FF", season()), ("2026-06-20", "arm", "ST", season(whiffs=120.0))])
    rows = [("change_vs_baseline", "player", "hot", "MLB", {"recent_days": 14}), ("luck_gap", "player", "hot", "MLB", {"x": 1}), ("new_pitch", "player", "arm", "MLB", {"pitch_type": "ST", "since": "2026-06-01"}), ("velocity_change", "player", "arm", "MLB", {"since": "2026-06-01", "pitch_type": "FF"}), ("hitting_streak", "player", "hot", "MLB", {"games": 12}), ("change_vs_baseline", "player", "off", "NPB", {"recent_days": 14}), ("luck_gap", "player", "nobody", "MLB", {})]
    df = spark.createDataFrame([(*r[:4], json.dumps(r[4])) for r in rows], "detector string, subject_type string, subject_id string, league_code string, facts_json string")
    out = {(r.detector, r.subject_id): json.loads(r.facts_json) for r in dr.attached(df, batters, pitchers, "2026-06-30").collect()}
    assert len(out) == len(rows)
    names = {k: [d["metric"] for d in v["drivers"]] for k, v in out.items() if "drivers" in v}
    assert names["change_vs_baseline", "hot"] == ["whiff_rate", "chase_rate", "fastball_chase_rate"] or set(names["change_vs_baseline", "hot"]) == {"whiff_rate", "chase_rate", "fastball_chase_rate"}
    assert names["luck_gap", "hot"][0] == "hard_hit_rate" and all(d["vs"] == "league" for d in out["luck_gap", "hot"]["drivers"])
    assert "new_pitch_whiff_rate" in names["new_pitch", "arm"] and not any(m.startswith("new_pitch") for m in names["velocity_change", "arm"])
    assert names["luck_gap", "nobody"] == [] and ("hitting_streak", "hot") not in names and ("change_vs_baseline", "off") not in names
    assert out["new_pitch", "arm"]["pitch_type"] == "ST" and df.where(F.expr("false")).count() == 0
