"""As-of windows of a range of days, grids of penalties and range publishing, against loops and full rebuilds."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from infield.operators import gold, ml
from infield.plans import publish as pub
from infield.sources import lake

CFG = ml.Breakout(baseline_days=6, recent_days=3, label_days=4, min_baseline_pa=4, min_label_pa=2)
SPLITS = ml.Splits("2025-05-20", "2025-06-02", 4)
LINE = "dt string, player_id string, league_code string, " + ", ".join(f"{s} long" for s in ml.STATS[:-1]) + ", woba_value double, source string"


def day(n):
    return (date(2025, 5, 1) + timedelta(days=n)).isoformat()


def drawn_lines(seed=3, players=9, days=45):
    r = random.Random(seed)
    out = []
    for p in range(players):
        for n in range(days):
            if r.random() < 0.45 and not 12 < n < 22 - p:
                pa = r.randint(1, 5)
                ab, so = r.randint(0, pa), r.randint(0, 1)
                out.append((day(n), f"p{p}", "NPB" if p % 3 == 0 else "MLB", pa, ab, min(ab, 1), 0, 0, r.randint(0, 1) if ab > 1 else 0, pa - ab, 0, so if ab else 0, 0, 0, pa, round(r.choice([0.0, 0.69, 0.88, 2.03]) * r.randint(0, pa), 6), "mlb_statcast"))
    return out


def plain_examples(lines, published, as_of):
    """Window sums of one day by loops."""
    span = lambda a, b: {(date.fromisoformat(as_of) + timedelta(days=n)).isoformat() for n in range(a, b + 1)}
    windows = {"base": span(1 - CFG.baseline_days, 0), "recent": span(1 - CFG.recent_days, 0), "day": span(0, 0), "label": span(1, CFG.label_days)}
    names = ["dt", "player_id", "league_code", *ml.STATS, "source"]
    sums = {}
    for line in lines:
        row = dict(zip(names, line, strict=True))
        for w, days in windows.items():
            if row["dt"] in days:
                own = sums.setdefault((row["player_id"], row["league_code"]), {})
                for s in ml.STATS:
                    own[w, s] = own.get((w, s), 0) + row[s]
                own[w, "days"] = own.get((w, "days"), 0) + 1
    get = lambda own, w, s: own.get((w, s), 0)
    rate = lambda a, b: round(a / b, 6) if b else None
    done = windows["label"] <= set(published)
    out = {}
    for (player, league), own in sums.items():
        if get(own, "base", "pa") < CFG.min_baseline_pa:
            continue
        mates = [o for (_, lg), o in sums.items() if lg == league]
        base, label = rate(get(own, "base", "woba_value"), get(own, "base", "woba_den")), rate(get(own, "label", "woba_value"), get(own, "label", "woba_den"))
        enough = done and get(own, "label", "pa") >= CFG.min_label_pa and base is not None and label is not None
        out[player] = {
            "f_base_pa": get(own, "base", "pa"), "f_base_woba": base, "f_base_days": get(own, "base", "days"), "f_recent_pa": get(own, "recent", "pa"), "f_recent_woba": rate(get(own, "recent", "woba_value"), get(own, "recent", "woba_den")), "f_day_pa": get(own, "day", "pa"), "f_day_hr": get(own, "day", "hr"),
            "f_league_base_woba": rate(sum(get(o, "base", "woba_value") for o in mates), sum(get(o, "base", "woba_den") for o in mates)), "f_base_k_rate": rate(get(own, "base", "so"), get(own, "base", "pa")), "label_pa": get(own, "label", "pa") if done else None, "label_woba": label if done else None,
            "label_status": "pending" if not done else "labeled" if enough else "insufficient_pa", "label_breakout": round(label - base, 6) >= CFG.margin_woba - 1e-9 if enough else None,
        }
    return out


def test_a_range_equals_each_day_by_loops(spark):
    lines = drawn_lines()
    published = [day(n) for n in range(45) if n not in (17, 30)]
    df, days = spark.createDataFrame(lines, LINE), spark.createDataFrame([(d,) for d in published], "dt string")
    found = {}
    for r in ml.example_range(df, days, day(3), day(41), CFG, SPLITS).collect():
        found.setdefault(r.dt, {})[r.player_id] = r
    asked = [d for d in published if day(3) <= d <= day(41)]
    assert set(found) <= set(asked) and len(found) > 25
    statuses = set()
    for d in asked:
        want = plain_examples(lines, published, d)
        assert set(found.get(d, {})) == set(want), d
        for player, values in want.items():
            r = found[d][player]
            statuses.add(r.label_status)
            for name, value in values.items():
                assert r[name] == (pytest.approx(value, abs=2e-6) if isinstance(value, float) else value), (d, player, name)
            assert r.split == {True: "train"}.get(d <= day(15), r.split)
    assert statuses == {"pending", "labeled", "insufficient_pa"}


def test_one_day_is_a_range_of_one(spark):
    lines = drawn_lines(4)
    df, days = spark.createDataFrame(lines, LINE), spark.createDataFrame([(day(n),) for n in range(45)], "dt string")
    whole = {tuple(r) for r in ml.example_range(df, days, day(0), day(44), CFG, SPLITS).where(F.col("dt") == day(20)).collect()}
    assert {tuple(r) for r in ml.examples(df, days, day(20), CFG, SPLITS).collect()} == whole and whole
    unpublished = ml.examples(df, days.where(F.col("dt") != day(20)), day(20), CFG, SPLITS)
    assert unpublished.count() == len(whole)
    assert ml.example_range(df.limit(0), days, day(0), day(44), CFG, SPLITS).count() == 0


def test_prefix_sums_are_dealt_once(spark):
    df, days = spark.createDataFrame(drawn_lines(), LINE), spark.createDataFrame([(day(n),) for n in range(45)], "dt string")
    sums = ml.window_sums(df, days, day(0), day(44), ["player_id", "league_code"], ml.STATS, {"base": (-29, 0), "label": (1, 14), "a": (-3, 9), "b": (0, 0)})
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(player_id") <= 2  # the lines' spans, and lines with grid


def test_all_penalties_at_once_equal_single_fits(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 3))
    y = rng.random(3000) < 1 / (1 + np.exp(-(0.3 + x @ [1.2, -0.7, 0.0])))
    rows = [(float(a), float(b), None if i % 17 == 0 else float(c), bool(t) if i % 23 else None) for i, ((a, b, c), t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "x_u double, x_v double, x_w double, y boolean").repartition(4)
    grid = [0.01, 1.0, 30.0, 1000.0]
    together = ml.fit_grid(df, "y", ["u", "v", "w"], grid)
    for l2, model in zip(grid, together, strict=True):
        alone = ml.fit(df, "y", ["u", "v", "w"], l2)
        assert (alone.intercept, *alone.coefficients) == pytest.approx((model.intercept, *model.coefficients), abs=1e-7)
    # the gradient is zero at the end: by plain sums
    m = together[1]
    known = [r for r in rows if r[3] is not None]
    z = np.array([[((v - mu) / s if v is not None else 0.0) for v, mu, s in zip(r[:3], m.means, m.deviations, strict=True)] for r in known])
    p = 1 / (1 + np.exp(-(m.intercept + z @ np.array(m.coefficients))))
    t = np.array([r[3] for r in known], float)
    assert abs((t - p).sum()) < 1e-3 and np.abs(z.T @ (t - p) - m.l2 * np.array(m.coefficients)).max() < 1e-3
    scored = {r.name: r for r in ml.losses(df, {str(i): mm.score() for i, mm in enumerate(together)}, "y").collect()}
    for i, mm in enumerate(together):
        one = ml.evaluate(df.where("y is not null").withColumn("p", mm.score()), "p", "y").first()
        assert (scored[str(i)].auc, scored[str(i)].log_loss, scored[str(i)].rows) == (pytest.approx(one.auc), pytest.approx(one.log_loss), one["rows"])
    with pytest.raises(ValueError):
        ml.fit_grid(df.limit(0), "y", ["u"], [1.0])


def test_heuristics_in_one_pass(spark):
    rows = [(0.3 + i / 100, 0.3, (i % 5) / 10 - 0.2, i % 3, i % 4 == 0 or i > 30) for i in range(40)]
    df = spark.createDataFrame(rows, "f_recent_woba double, f_base_woba double, f_base_woba_vs_league double, f_day_hr long, y boolean")
    found = {r.name: r.auc for r in ml.heuristic_aucs(df, "y").collect()}
    scores = {"recent_minus_base_woba": lambda r: r[0] - r[1], "base_woba_below_league": lambda r: -r[2], "home_runs_of_the_day": lambda r: r[3]}
    for name, f in scores.items():
        pos, neg = [f(r) for r in rows if r[4]], [f(r) for r in rows if not r[4]]
        assert found[name] == pytest.approx(sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg)))


# Range publishing ---------------------------------------------------------------------------------------

def test_closure_of_a_change():
    tables = pub.derived_tables(6, 4, {})
    days = [day(n) for n in range(40)] + ["2026-04-01"]
    found = pub.affected(tables, {"fact_plate_appearance": [day(20)]}, days)
    assert found["run_expectancy_daily"] == [day(20)] == found["feature_batter_daily"]
    assert found["run_expectancy"] == [day(n) for n in range(20, 40)]  # the rest of the season, no other
    assert found["ml_breakout"] == [day(n) for n in range(16, 26)] == found["ml_breakout_score"]
    late = pub.affected(tables, {"ml_split": [day(30)]}, days)
    assert late["ml_breakout"] == [day(n) for n in range(26, 31)] and "run_expectancy" not in late
    with pytest.raises(ValueError, match="each other"):
        pub.ordered([pub.Table("a", [pub.Reads("b")]), pub.Table("b", [pub.Reads("a")])])
    with pytest.raises(ValueError):
        pub.Reads("a", 1, 0)


def appearances(seed, days):
    r = random.Random(seed)
    rows = []
    for n in days:
        for i in range(30):
            e = r.choice(["1B", "HR", "BB", "K", "OUT", "TRUNCATED"])
            rows.append((day(n), "mlb_statcast", f"b{r.randint(0, 6)}", e, r.randint(0, 7), r.randint(0, 2), r.choice([None, 0, 1, 2])))
    return rows


PA = "dt string, source string, batter_id string, event_type string, base_state_before int, outs_before int, runs_to_end_of_inning int"
MODEL = ml.Model(ml.INPUTS, [0.0] * 9, [1.0] * 9, [0.1] * 9, 0.0, 1.0, CFG.version)


def builds():
    return {
        "run_expectancy_daily": lambda read, days: gold.run_expectancy_daily(read("fact_plate_appearance").where(F.col("dt").isin(days))),
        "run_expectancy": lambda read, days: gold.run_expectancy(read("run_expectancy_daily").drop("ingested_at_utc"), read("ml_split")),
        "feature_batter_daily": lambda read, days: ml.batter_daily(read("fact_plate_appearance").where(F.col("dt").isin(days)), CFG),
        "ml_breakout": lambda read, days: ml.example_range(read("feature_batter_daily"), read("ml_split"), min(days), max(days), CFG, SPLITS),
        "ml_breakout_score": lambda read, days: ml.candidates(read("ml_breakout").where(F.col("dt").isin(days)), MODEL, CFG),
    }


def state(spark, root):
    out = {}
    for t in pub.derived_tables(6, 4, {}):
        df = lake.read(spark, root, t.name)
        columns = sorted(c for c in df.columns if c != "ingested_at_utc")
        out[t.name] = sorted((tuple(None if isinstance(r[c], float) and math.isnan(r[c]) else r[c] for c in columns) for r in df.collect()), key=repr)
    return out


def test_a_changed_day_is_published_like_a_full_rebuild(spark, tmp_path):
    tables, every = pub.derived_tables(6, 4, builds()), [day(n) for n in range(24)]

    def write(root, rows, days):
        lake.write_days(spark.createDataFrame(rows, PA), root, "fact_plate_appearance", days)
        split = spark.createDataFrame([(d, "x") for d in days], "dt string, split string")
        lake.write_days(split, root, "ml_split", days)

    first, changed = appearances(1, [n for n in range(24) if n != 12]), appearances(2, [9])
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    write(one, first, [d for d in every if d != day(12)])
    pub.publish(spark, one, tables, {"fact_plate_appearance": every, "ml_split": every}, every)
    before = state(spark, one)
    # day 9 changes, day 12 comes late
    late = appearances(3, [12])
    lake.write_days(spark.createDataFrame(changed + late, PA), one, "fact_plate_appearance", [day(9), day(12)])
    lake.write_days(spark.createDataFrame([(day(12), "x")], "dt string, split string"), one, "ml_split", [day(12)])
    written = pub.publish(spark, one, tables, {"fact_plate_appearance": [day(9), day(12)], "ml_split": [day(12)]}, every)
    assert written["run_expectancy"] == every[9:] and written["ml_breakout"] == every[5:18] and written["feature_batter_daily"] == [day(9), day(12)]
    write(two, [r for r in first if r[0] != day(9)] + changed + late, every)
    pub.publish(spark, two, tables, {"fact_plate_appearance": every, "ml_split": every}, every)
    after = state(spark, one)
    assert after == state(spark, two) and after != before and all(after.values())
    again = pub.publish(spark, one, tables, {"fact_plate_appearance": [day(9)]}, every)
    assert "ml_breakout" in again and state(spark, one) == after
