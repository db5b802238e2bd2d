"""Results that rounding or a narrower statement once changed."""

import datetime
import hashlib

import duckdb
from pyspark.sql import functions as F

from infield import queries
from infield.functions import columns as fx
from infield.operators import insights, ml
from infield.operators import relational as r


def test_latest_snapshot_of_each_group(spark):
    rows = [("a", 1, "2024-01-01"), ("a", 2, "2024-01-03"), ("a", 3, "2024-01-03"), ("b", 4, "2024-01-02"), (None, 5, "2024-01-01"), ("b", 6, None)]
    df = spark.createDataFrame(rows, "g string, n long, dt string")
    assert {x.n for x in r.latest_snapshot(df, "dt", ["g"]).collect()} == {2, 3, 4, 5}
    assert {x.n for x in r.latest_snapshot(df).collect()} == {2, 3}


def test_newest_orders_are_those_of_every_segment(spark, tmp_path):
    day = datetime.date
    spark.createDataFrame([(1, "X"), (2, "Y"), (3, "Y")], "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(10, 1, day(1998, 1, 1)), (11, 2, day(1997, 5, 5)), (12, 3, day(1997, 5, 5)), (13, 3, day(1996, 1, 1))], "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    found = queries.queries()["S18_latest_snapshot"](spark, str(tmp_path)).select("c_mktsegment", "o_orderkey").collect()
    assert {tuple(x) for x in found} == {("X", 10), ("Y", 11), ("Y", 12)}




def test_rounding_is_in_units_of_the_last_place(spark):
    values = [0.2580375, -0.2580375, 0.47575, 2.5, None, float("inf"), 1e308, 0.1]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    six, four = zip(*[tuple(x) for x in df.select(fx.rounded("x", 6), fx.rounded("x", 4)).collect()], strict=True)
    assert six == (0.258037, -0.258037, 0.47575, 2.5, None, float("inf"), 1e308, 0.1)
    assert duckdb.sql("SELECT round(0.47575::DOUBLE, 4), round(0.2580375::DOUBLE, 6)").fetchall() == [(four[2], six[0])]


def test_rates_at_a_tie_equal_their_sql(spark):
    """Eight plate appearances whose mean is half a unit of the last place."""
    daily = spark.createDataFrame([("2024-01-10", "p", "MLB", 8, 2.0643)], "dt string, player_id string, league_code string, pa long, woba_value double")
    lines = daily.withColumns({c: F.lit(0).cast("long") for c in ml.STATS if c not in daily.columns and c != "woba_den"}).withColumn("woba_den", F.col("pa"))
    cfg = ml.Breakout(baseline_days=8, recent_days=3, label_days=5, min_baseline_pa=1, min_label_pa=1, margin_woba=0.05)
    row = ml.example_range(lines, daily.select("dt"), "2024-01-10", "2024-01-10", cfg, ml.Splits("2024-01-12", "2024-01-20", 5)).first()
    assert (row.f_base_woba, row.f_recent_woba, row.f_league_base_woba) == (0.258037,) * 3


def test_changes_do_not_hang_on_the_order_of_the_rows(spark):
    """Days whose sum in doubles depends on their order: the exact sum's mean is a tie of the fourth place."""
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 0.00035, 0.1, 0.2]
    row = lambda i, v: (f"2024-01-{20 + i:02d}", "p", 1, v)
    base = [("2024-01-02", "p", 1, 5.0)]
    cfg = {"recent_days": 14, "min_recent_pa": 1, "min_baseline_pa": 1, "min_abs_z": 0.0, "woba_sd_per_pa": 0.5}
    found = set()
    for order in (values, values[::-1], sorted(values)):
        rows = base + [row(i, v) for i, v in enumerate(order)]
        daily = spark.createDataFrame(rows, "dt string, player_id string, woba_den long, woba_value double").coalesce(1).withColumns({"pa": F.col("woba_den"), "league_code": F.lit("MLB")})
        found.add(insights.change_vs_baseline(daily, "2024-01-30", cfg).first().value)
    assert found == {0.1125}


def test_canonical_ids_take_few_conversions(spark):
    """Equal to five bits at a time of the hash, with a conversion for each long instead of one for each four digits."""
    keys = [f"player:source:s:{i}" for i in range(2000)] + ["", "é漢", None]
    frame = spark.createDataFrame([(k,) for k in keys], "k string").select("k", fx.canonical_id("k", "infield").alias("id"))
    for row in frame.collect():
        if row.k is None:
            assert row.id is None
            continue
        bits = int(hashlib.sha256(f"{row.k}|infield".encode()).hexdigest(), 16) >> 126
        assert row.id == "".join("0123456789ABCDEFGHJKMNPQRSTVWXYZ"[bits >> (125 - 5 * i) & 31] for i in range(26))
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("conv(") == 3
