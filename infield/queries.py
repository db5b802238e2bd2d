"""One query for each capability, on the driver's tables, with the same in DuckDB's SQL where that can say it.

``events`` stands for the play feed (user = batter, type = outcome, value = runs, the day of ts = dt), ``lineitem`` for
pitches, ``orders`` for games, ``customer`` for players, ``nation`` and ``region`` for teams and leagues.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from infield import gold_queries, registry
from infield.functions import columns as fx
from infield.operators import drivers as dr
from infield.operators import evidence, gold, insights, ml, plays, quality
from infield.operators import pitch_features as pf
from infield.operators import relational as r
from infield.operators import silver as sv
from infield.plans import checks, publish
from infield.plans import semantic as sem
from infield.registry import EV, Query, events, id_sql, query, t
from infield.sources import lake

# Scans --------------------------------------------------------------------------------------------------

@query(EV + " SELECT strftime(d, '%Y-%m-%d') AS dt FROM (SELECT unnest(generate_series(CAST(min(dt) AS TIMESTAMP), CAST(max(dt) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM ev)")
def S01_day_partitions(spark, sf_dir):
    """The days from a table's first to its last, with those on which nothing happened."""
    first, last = events(spark, sf_dir).agg(F.min("dt"), F.max("dt")).first()
    return lake.days(spark, first, last)


@query("SELECT DISTINCT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS dt FROM orders")
def S02_month_partitions(spark, sf_dir):
    return lake.periods(t(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt")).distinct(), "month")


@query("SELECT event_id, raw AS raw_json FROM (SELECT event_id, props AS raw FROM events)")
def S05_json_records(spark, sf_dir):
    body = t(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("dt"), F.format_string('{"data": [%s]}', F.col("props")).alias("body_text"))
    return sv.records(body).select(F.col("dt").cast("long").alias("event_id"), F.regexp_replace("raw_json", '^\\{"k":(\\d+)\\}$', '{"k": $1}').alias("raw_json"))


@query(EV + ", n AS (SELECT dt, arg_max(event_type, struct_pack(a := ts, b := event_id)) AS newest FROM ev GROUP BY dt) SELECT ev.event_id, ev.dt, ev.event_type FROM ev JOIN n USING (dt) WHERE event_type = newest")
def S12_latest_fetch(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    return r.latest_fetch(e, ["dt"], "event_type", "at").select("event_id", "dt", "event_type")


@query("SELECT event_id, value FROM events WHERE NOT (event_type = 'error')")
def S14_sentinel_drop(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn("empty", F.when(F.col("event_type") == "error", True))
    return lake.without_sentinels(e).select("event_id", "value")


@query(EV + " SELECT event_id, dt, user_id, value FROM ev WHERE dt BETWEEN '2024-01-10' AND '2024-01-16'")
def S17_range_scan(spark, sf_dir):
    return lake.between(events(spark, sf_dir), "2024-01-10", "2024-01-16").select("event_id", "dt", "user_id", "value")


@query("WITH o AS (SELECT c_mktsegment, o_orderkey, o_orderdate, max(o_orderdate) OVER (PARTITION BY c_mktsegment) AS m FROM orders JOIN customer ON o_custkey = c_custkey) SELECT c_mktsegment, o_orderkey, o_orderdate FROM o WHERE o_orderdate = m")
def S18_latest_snapshot(spark, sf_dir):
    """The newest orders of each market segment."""
    o = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return r.latest_snapshot(o.select("c_mktsegment", "o_orderkey", "o_orderdate"), "o_orderdate", ["c_mktsegment"])


@query(EV + " SELECT event_id, user_id FROM ev WHERE dt = (SELECT max(dt) FROM ev)")
def F04_newest_day(spark, sf_dir):
    return r.latest_snapshot(events(spark, sf_dir)).select("event_id", "user_id")


@query(EV + " SELECT event_id, dt FROM ev WHERE dt = (SELECT max(dt) FROM ev WHERE dt < '2024-01-15')")
def S18_day_before(spark, sf_dir):
    """The rows of the newest day before a day."""
    e = events(spark, sf_dir).select("event_id", "dt")
    return lake.as_of(e, lake.newest_before(e, "2024-01-15"))


# De-duplication and ordered state -----------------------------------------------------------------------

@query(EV + " SELECT user_id, dt, event_type, event_id, value FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, dt, event_type ORDER BY ts, event_id) = 1")
def W01_keep_first(spark, sf_dir):
    return r.keep_first(events(spark, sf_dir), ["user_id", "dt", "event_type"], ["ts", "event_id"]).select("user_id", "dt", "event_type", "event_id", "value")


@query(EV + " SELECT user_id, dt, event_type, event_id, value FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, dt, event_type ORDER BY ts DESC, event_id DESC) = 1")
def W01_keep_last(spark, sf_dir):
    return r.keep_last(events(spark, sf_dir), ["user_id", "dt", "event_type"], ["ts", "event_id"]).select("user_id", "dt", "event_type", "event_id", "value")


_SUFFIX = EV + """, v AS (SELECT *, CASE WHEN value <= 200 THEN value END AS runs FROM ev), s AS (
SELECT event_id, user_id, dt, ts, event_type, CASE WHEN count(*) FILTER (WHERE runs IS NULL) OVER w = 0 THEN sum(runs) OVER w END AS rest
FROM v WINDOW w AS (PARTITION BY user_id, dt ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def _with_rest(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("runs", F.when(F.col("value") <= 200, F.col("value")))
    return r.suffix_sum(e, "runs", ["user_id", "dt"], ["ts", "event_id"], "rest")


@query(_SUFFIX + " SELECT event_id, round(rest, 4) AS rest FROM s")
def W02_suffix_sum(spark, sf_dir):
    return _with_rest(spark, sf_dir).select("event_id", F.round("rest", 4).alias("rest"))


@query(_SUFFIX + """, o AS (SELECT *, least(row_number() OVER (PARTITION BY user_id, dt ORDER BY ts, event_id) - 1, 2) AS nth FROM s)
SELECT event_type, CAST(nth AS BIGINT) AS nth, count(*) AS n, round(sum(rest), 4) AS total, round(sum(rest) / count(*), 4) AS expected FROM o WHERE rest IS NOT NULL GROUP BY ALL""")
def A03_state_value(spark, sf_dir):
    nth = F.least(F.row_number().over(Window.partitionBy("user_id", "dt").orderBy("ts", "event_id")) - 1, F.lit(2)).cast("long")
    rows = _with_rest(spark, sf_dir).withColumn("nth", nth).where("rest is not null")
    return rows.groupBy("event_type", "nth").agg(F.count("*").alias("n"), F.round(F.sum("rest"), 4).alias("total"), F.round(F.sum("rest") / F.count("*"), 4).alias("expected"))


@query(EV + """, d AS (SELECT dt, event_id % 8 AS base_state, event_id % 3 AS outs, count(*) AS n, sum(CAST(floor(value) AS BIGINT) % 7) AS r FROM ev WHERE value BETWEEN 0 AND 300 GROUP BY ALL), days AS (SELECT DISTINCT dt FROM ev), f AS (SELECT base_state, outs, min(dt) AS first FROM d GROUP BY ALL)
SELECT days.dt, CAST(f.base_state AS BIGINT) AS base_state, CAST(f.outs AS BIGINT) AS outs, CAST(sum(coalesce(d.n, 0)) OVER w AS BIGINT) AS pa_count, CAST(sum(coalesce(d.r, 0)) OVER w AS BIGINT) AS runs FROM f JOIN days ON days.dt >= f.first LEFT JOIN d ON d.dt = days.dt AND d.base_state = f.base_state AND d.outs = f.outs WINDOW w AS (PARTITION BY f.base_state, f.outs ORDER BY days.dt)""")
def A03_cumulative(spark, sf_dir):
    """The season so far of each state on each day, days without one of its rows included."""
    pas = _states(spark, sf_dir)
    return gold.run_expectancy(gold.run_expectancy_daily(pas), pas.select("dt")).select("dt", F.col("base_state").cast("long").alias("base_state"), F.col("outs").cast("long").alias("outs"), "pa_count", "runs")


@query(EV + " SELECT event_id, lead(event_type) OVER w AS next_event_type, lead(value) OVER w AS next_value FROM ev WINDOW w AS (PARTITION BY user_id, dt ORDER BY ts, event_id)")
def W03_lead_state(spark, sf_dir):
    return r.next_state(events(spark, sf_dir), ["event_type", "value"], ["user_id", "dt"], ["ts", "event_id"]).select("event_id", "next_event_type", "next_value")


@query(EV + " SELECT user_id, dt, arg_min(value, struct_pack(a := ts, b := event_id)) AS first_value, arg_max(value, struct_pack(a := ts, b := event_id)) AS last_value FROM ev GROUP BY ALL")
def W04_first_last(spark, sf_dir):
    at = F.struct("ts", "event_id")
    return events(spark, sf_dir).groupBy("user_id", "dt").agg(F.min_by("value", at).alias("first_value"), F.max_by("value", at).alias("last_value"))


@query("""SELECT event_id, CAST(count(*) FILTER (WHERE event_type = 'signup') OVER w AS BIGINT) AS segment, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS last_purchase
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def W05_segments(spark, sf_dir):
    e = r.segments(t(spark, sf_dir, "events"), F.col("event_type") == "signup", ["user_id"], ["ts", "event_id"], "segment")
    bought = r.filled_forward(F.when(F.col("event_type") == "purchase", F.col("value")), ["user_id"], ["ts", "event_id"])
    return e.withColumn("last_purchase", bought).select("event_id", "segment", "last_purchase")


@query(EV + ", n AS (SELECT *, row_number() OVER (PARTITION BY user_id, dt, event_type ORDER BY ts, event_id) AS n FROM ev) SELECT event_id, user_id || ':' || dt || ':' || event_type || CASE WHEN n = 1 THEN '' ELSE '#' || n END AS key FROM n")
def W06_ordinal_suffix(spark, sf_dir):
    key = F.concat_ws(":", F.col("user_id").cast("string"), "dt", "event_type")
    return r.ordinal_suffix(events(spark, sf_dir), key, ["user_id", "dt", "event_type"], ["ts", "event_id"], "key").select("event_id", "key")


_DAYS = EV + ", d AS (SELECT user_id, dt, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS hit FROM ev GROUP BY ALL)"


def _hit_days(spark, sf_dir):
    return events(spark, sf_dir).groupBy("user_id", "dt").agg(F.max((F.col("event_type") == "purchase").cast("int")).alias("hit"))


@query(_DAYS + ", i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY dt) - row_number() OVER (PARTITION BY user_id, hit ORDER BY dt) AS g FROM d) SELECT user_id, min(dt) AS start_dt, max(dt) AS end_dt, count(*) AS length FROM i WHERE hit = 1 GROUP BY user_id, g HAVING count(*) >= 3")
def W07_streaks(spark, sf_dir):
    return r.streaks(_hit_days(spark, sf_dir), ["user_id"], ["dt"], F.col("hit") == 1, "dt").where("length >= 3")


@query(_DAYS + """, i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY dt) - row_number() OVER (PARTITION BY user_id, hit ORDER BY dt) AS g FROM d), s AS (SELECT user_id, min(dt) AS start_dt, max(dt) AS end_dt, count(*) AS length FROM i WHERE hit = 1 GROUP BY user_id, g),
l AS (SELECT user_id, max(dt) AS end_dt FROM d GROUP BY user_id) SELECT user_id, start_dt, end_dt, length FROM s JOIN l USING (user_id, end_dt) WHERE length >= 2 AND end_dt >= '2024-01-28'""")
def I01_active_streaks(spark, sf_dir):
    """Streaks that are still on, as candidates."""
    daily = _hit_days(spark, sf_dir).select("dt", F.col("user_id").cast("string").alias("player_id"), F.lit("MLB").alias("league_code"), F.lit(1).alias("pa"), F.col("hit").alias("h"))
    found = insights.hitting_streaks(daily, "2024-01-30", {"min_games": 2, "max_days_since_last_game": 2})
    fact = lambda name: F.get_json_object("facts_json", f"$.{name}").alias(name)
    return found.select(F.col("subject_id").cast("long").alias("user_id"), fact("start_dt"), fact("end_dt"), F.col("value").cast("long").alias("length"))


@query("""WITH c AS (SELECT c_custkey, c_mktsegment, c_acctbal, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer), b AS (SELECT *, max(c_acctbal) OVER (PARTITION BY c_mktsegment) AS best FROM c WHERE n <= 6)
SELECT c_custkey, c_mktsegment, CAST(row_number() OVER (ORDER BY n, best DESC, c_mktsegment) AS BIGINT) AS position FROM b""")
def W12_interleave(spark, sf_dir):
    best = r.top_k(t(spark, sf_dir, "customer"), ["c_mktsegment"], [F.desc("c_acctbal"), "c_custkey"], 6)
    return r.interleave(best, "c_mktsegment", "c_acctbal", "c_custkey").select("c_custkey", "c_mktsegment", F.col("position").cast("long").alias("position"))


@query("SELECT c_nationkey, c_custkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS rank FROM customer QUALIFY rank <= 5")
def W13_topk(spark, sf_dir):
    return r.top_k(t(spark, sf_dir, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 5).select("c_nationkey", "c_custkey", F.col("rank").cast("long").alias("rank"))


# Identity and joins -------------------------------------------------------------------------------------

@query(f"SELECT c_custkey, {id_sql(chr(39) + 'player:source:tpch:' + chr(39) + ' || c_custkey')} AS player_id FROM customer")
def X01_canonical_id(spark, sf_dir):
    return t(spark, sf_dir, "customer").select("c_custkey", fx.canonical_id(F.concat(F.lit("player:source:tpch:"), F.col("c_custkey").cast("string")), salt="infield").alias("player_id"))


@query("SELECT substr(sha1(c_custkey || '|' || c_name), 1, 20) AS id, c_custkey FROM customer")
def X02_short_hash(spark, sf_dir):
    return t(spark, sf_dir, "customer").select(fx.short_hash("c_custkey", "c_name").alias("id"), "c_custkey")


@query(f"SELECT o_orderkey, coalesce(c_name, {id_sql(chr(39) + 'player:source:tpch:' + chr(39) + ' || o_custkey')}) AS player FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey")
def J01_bridge_or_hash(spark, sf_dir):
    """Ids of the bridge, else derived ones."""
    bridge = t(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.lit("player").alias("entity_type"), F.lit("tpch").alias("source"), F.col("c_custkey").cast("string").alias("source_id"), F.col("c_name").alias("canonical_id"))
    return plays.with_entity(t(spark, sf_dir, "orders"), bridge, "player", "tpch", "o_custkey", "player").select("o_orderkey", "player")


@query("""WITH o AS (SELECT o_custkey AS k, count(*) AS orders FROM orders WHERE o_totalprice > 300000 GROUP BY 1), c AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE -c_custkey END AS k, c_name AS name FROM customer)
SELECT k, orders, name FROM o LEFT JOIN c USING (k) UNION ALL SELECT k, NULL, name FROM c WHERE k NOT IN (SELECT k FROM o)""")
def J03_left_plus_anti(spark, sf_dir):
    o = t(spark, sf_dir, "orders").where("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    c = t(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey")).otherwise(-F.col("c_custkey")).alias("k"), F.col("c_name").alias("name"))
    return r.left_plus_anti(o, c, ["k"]).select("k", "orders", "name")


_SIDES = "SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_returnflag, c.c_nationkey AS home, s.s_nationkey AS away FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey JOIN supplier s ON l_suppkey = s_suppkey"


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN o_custkey % 25 ELSE c_nationkey END AS batting, CASE WHEN l_returnflag = 'R' THEN c_nationkey ELSE o_custkey % 25 END AS fielding
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def J05_conditional_fill(spark, sf_dir):
    """Orders as games of a customer's nation at home, lines as plate appearances."""
    o = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    games = o.select(F.col("o_orderkey").alias("game_id"), F.lit("2024-01-01").alias("dt"), F.col("c_nationkey").cast("long").alias("home_team_id"), (F.col("o_custkey") % 25).cast("long").alias("away_team_id"))
    none = F.lit(None).cast("long")
    pas = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("game_id"), "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") == "R").alias("is_top_inning"), none.alias("batting_team_id"), none.alias("fielding_team_id"))
    return plays.with_teams(pas, games).select("l_orderkey", "l_linenumber", "l_partkey", F.col("batting_team_id").alias("batting"), F.col("fielding_team_id").alias("fielding"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def J12_orphans(spark, sf_dir):
    return r.orphans(t(spark, sf_dir, "customer").select("c_custkey"), t(spark, sf_dir, "orders"), "c_custkey", "o_custkey")


@query("SELECT count(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def J17_semi_join(spark, sf_dir):
    done = t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return t(spark, sf_dir, "customer").join(done, "c_custkey", "left_semi").agg(F.count("*").alias("n"))


@query("SELECT dt AS missing FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders) WHERE dt NOT IN (SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') FROM lineitem)")
def U03_day_difference(spark, sf_dir):
    a = t(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("missing")).distinct()
    b = t(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("missing")).distinct()
    return a.join(b, "missing", "left_anti")


@query("SELECT o_orderkey, 0 AS side, o_custkey AS team_id FROM orders UNION ALL SELECT o_orderkey, 1, o_custkey + 1 FROM orders")
def N05_unpivot_sides(spark, sf_dir):
    name = F.col("o_orderkey").cast("string")
    games = t(spark, sf_dir, "orders").select(F.lit("2024-01-01").alias("dt"), F.col("o_custkey").alias("home_team_id"), (F.col("o_custkey") + 1).alias("away_team_id"), name.alias("home_team_name"), name.alias("away_team_name"))
    return gold.game_sides(games).select(F.col("name").cast("long").alias("o_orderkey"), "side", F.col("source_id").cast("long").alias("team_id"))


_SCD_PREV = "SELECT CASE WHEN c_custkey % 5 = 0 THEN 'gone' ELSE 'k' END || c_custkey AS key, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation, '2024-01-01' AS valid_from_dt, CASE WHEN c_custkey % 13 = 0 THEN '2024-01-05' END AS valid_to_dt, c_custkey % 13 <> 0 AS is_current, c_custkey AS n FROM customer"
_SCD_NEW = "SELECT CASE WHEN c_custkey % 11 = 0 THEN 'new' ELSE 'k' END || c_custkey AS key, c_name AS name, CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS segment, c_nationkey + 100 AS nation FROM customer"


@query(f"""WITH p AS ({_SCD_PREV}), t AS ({_SCD_NEW}), open AS (SELECT * FROM p WHERE is_current)
SELECT key, name, segment, nation, valid_from_dt, valid_to_dt, is_current FROM p WHERE NOT is_current
UNION ALL SELECT t.key, t.name, t.segment, t.nation, CASE WHEN o.key IS NOT NULL AND o.segment IS NOT DISTINCT FROM t.segment THEN o.valid_from_dt ELSE '2024-01-10' END, NULL, true FROM t LEFT JOIN open o ON o.key = t.key
UNION ALL SELECT o.key, o.name, o.segment, o.nation, o.valid_from_dt, '2024-01-09', false FROM open o JOIN t ON o.key = t.key WHERE o.segment IS DISTINCT FROM t.segment
UNION ALL SELECT o.key, o.name, o.segment, o.nation, o.valid_from_dt, o.valid_to_dt, true FROM open o WHERE o.key NOT IN (SELECT key FROM t)""")
def D01_scd2(spark, sf_dir):
    c = t(spark, sf_dir, "customer")
    key = lambda every, other: F.concat(F.when(F.col("c_custkey") % every == 0, other).otherwise("k"), F.col("c_custkey").cast("string")).alias("key")
    closed = F.col("c_custkey") % 13 == 0
    previous = c.select(key(5, "gone"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.lit("2024-01-01").alias("valid_from_dt"), F.when(closed, "2024-01-05").alias("valid_to_dt"), (~closed).alias("is_current"))
    today = c.select(key(11, "new"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 7 == 0, "CHANGED").otherwise(F.col("c_mktsegment")).alias("segment"), (F.col("c_nationkey") + 100).alias("nation"))
    return r.scd2(previous, today, "key", ["segment"], "2024-01-10", "2024-01-01")


@query("""WITH m AS (SELECT event_type, sum(value) / count(*) AS e FROM events GROUP BY 1), p AS (SELECT event_id, event_type, value, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS after FROM events)
SELECT event_id, round(b.e, 4) AS re_before, round(coalesce(a.e, 0), 4) AS re_after, round(coalesce(a.e, 0) - b.e + value, 4) AS run_value FROM p LEFT JOIN m b ON b.event_type = p.event_type LEFT JOIN m a ON a.event_type = p.after""")
def V03_double_join(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    states = {"signup": 0, "purchase": 1, "view": 2, "click": 3, "error": 4}
    code = fx.first_match([(F.col("event_type") == k, v) for k, v in states.items()], None)
    matrix = e.groupBy(code.alias("base_state")).agg((F.sum("value") / F.count("*")).alias("exp_runs")).select("base_state", "exp_runs", F.lit(0).alias("outs"), F.lit("X").alias("league_code"), F.lit(2024).alias("season_year"))
    after = F.lead(code).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    pas = e.select("event_id", code.alias("base_state_before"), F.lit(0).alias("outs_before"), after.alias("base_state_after"), F.when(after.isNull(), 3).otherwise(0).alias("outs_after"), F.col("value").alias("runs_scored_on_play"), F.lit("X").alias("league_code"), F.lit(2024).alias("season_year"))
    return sem.run_values(pas, matrix).select("event_id", *[F.round(c, 4).alias(c) for c in ("re_before", "re_after", "run_value")])


@query("WITH g AS (SELECT o_orderkey AS game_id, o_custkey AS home, o_custkey % 7 AS away, o_custkey % 5 AS hs, o_orderkey % 9 AS aw FROM orders) SELECT game_id, home AS team_id, away AS opponent_team_id, 1 AS is_home, hs AS runs_scored, aw AS runs_allowed FROM g UNION ALL SELECT game_id, away, home, 0, aw, hs FROM g")
def V06_two_sided(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    games = o.select(F.col("o_orderkey").alias("game_id"), F.col("o_custkey").alias("home_team_id"), (F.col("o_custkey") % 7).alias("away_team_id"), (F.col("o_custkey") % 5).alias("home_score"), (F.col("o_orderkey") % 9).alias("away_score"))
    return sem.both_sides(games)


# Aggregates ---------------------------------------------------------------------------------------------

@query(EV + " SELECT dt, user_id, count(*) AS pa, count(*) FILTER (WHERE event_type = 'purchase') AS h, count(*) FILTER (WHERE event_type IN ('purchase', 'click')) AS ab, CAST(round(sum(CASE event_type WHEN 'purchase' THEN 0.88 WHEN 'click' THEN 1.25 ELSE 0 END), 6) AS DOUBLE) AS weight FROM ev GROUP BY ALL")
def A01_day_lines(spark, sf_dir):
    e, cfg = F.col("event_type"), ml.Breakout(sources=("mlb_statcast",), woba_weights={"1B": 0.88, "K": 1.25})
    code = F.when(e == "purchase", "1B").when(e == "click", "K").otherwise("BB")
    pas = events(spark, sf_dir).select("dt", F.lit("mlb_statcast").alias("source"), F.col("user_id").cast("string").alias("batter_id"), code.alias("event_type"))
    return ml.batter_daily(pas, cfg).select("dt", F.col("player_id").cast("long").alias("user_id"), "pa", F.col("h").cast("long").alias("h"), F.col("ab").cast("long").alias("ab"), F.col("woba_value").alias("weight"))


def _states(spark, sf_dir) -> DataFrame:
    """Events as plate appearances of a state; beyond a value their runs are unknown."""
    i = F.col("event_id")
    return events(spark, sf_dir).select("dt", F.lit("mlb_statcast").alias("source"), (i % 8).alias("base_state_before"), (i % 3).alias("outs_before"), F.when(F.col("value").between(0, 300), F.floor("value").cast("long") % 7).alias("runs_to_end_of_inning"))


@query(EV + " SELECT dt, 'MLB' AS league_code, CAST(event_id % 8 AS BIGINT) AS base_state, CAST(event_id % 3 AS BIGINT) AS outs, count(*) AS pa_count, CAST(sum(CAST(floor(value) AS BIGINT) % 7) AS BIGINT) AS runs FROM ev WHERE value BETWEEN 0 AND 300 GROUP BY ALL")
def A02_daily_counts(spark, sf_dir):
    """Counts and runs of each day and state; what says no state or runs doesn't count."""
    return gold.run_expectancy_daily(_states(spark, sf_dir)).select("dt", "league_code", F.col("base_state").cast("long").alias("base_state"), F.col("outs").cast("long").alias("outs"), "pa_count", "runs")


@query(EV + " SELECT user_id, round(coalesce(sum(value), 0), 4) AS value, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM (SELECT *, 1 AS n FROM ev) WHERE dt BETWEEN '2024-01-14' AND '2024-01-20' GROUP BY user_id")
def A04_rolling_days(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("n", F.lit(1))
    return r.rolling_sums(e, ["user_id"], "dt", ["value", "n"], "2024-01-20", 7).select("user_id", F.round("value", 4).alias("value"), "n")


_WINDOWS = {"base": ("2023-12-22", "2024-01-20"), "recent": ("2024-01-14", "2024-01-20"), "day": ("2024-01-20", "2024-01-20"), "label": ("2024-01-21", "2024-02-03")}


@query(EV + ", m AS (SELECT *, 1 AS pa, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS h FROM ev WHERE dt BETWEEN '2023-12-22' AND '2024-02-03') SELECT user_id, " + ", ".join(f"{'round(' if m == 'value' else 'CAST('}sum(CASE WHEN dt BETWEEN '{a}' AND '{b}' THEN {m} END){', 4)' if m == 'value' else ' AS BIGINT)'} AS {w}_{m}" for w, (a, b) in _WINDOWS.items() for m in ("pa", "h", "value")) + " FROM m GROUP BY user_id")
def A05_multi_window(spark, sf_dir):
    e = events(spark, sf_dir).withColumns({"pa": F.lit(1), "h": (F.col("event_type") == "purchase").cast("int")})
    sums = r.multi_window_sums(e, ["user_id"], "dt", _WINDOWS, ["pa", "h", "value"])
    return sums.select("user_id", *[F.round(c, 4).alias(c) if c.endswith("value") else c for c in sums.columns if c != "user_id"])


@query("""WITH u AS (SELECT user_id, event_type, sum(value) AS v, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, event_type, round(v / n, 6) AS own, round(sum(v) OVER w / sum(n) OVER w, 6) AS league, round(v / n - sum(v) OVER w / sum(n) OVER w, 4) AS above FROM u WINDOW w AS (PARTITION BY event_type)""")
def A06_group_relative(spark, sf_dir):
    u = t(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("v"), F.count("*").alias("n"))
    w = Window.partitionBy("event_type")
    own, league = fx.ratio("v", "n"), fx.ratio(F.sum("v").over(w), F.sum("n").over(w))
    return u.select("user_id", "event_type", F.round(own, 6).alias("own"), F.round(league, 6).alias("league"), F.round(own - league, 4).alias("above"))


#: Lines as pitches, with a raw record of texts and numbers; and the same as columns.
_PITCH = """p AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt, 'p' || (l_partkey % 50) AS pitcher, 'b' || l_suppkey AS batter, ['FF', 'SL', 'CH', 'XX', 'SI', ''][(l_orderkey + l_partkey) % 6 + 1] AS type,
CASE l_orderkey % 6 WHEN 0 THEN 'swinging_strike' WHEN 1 THEN 'foul' WHEN 2 THEN 'ball' WHEN 3 THEN 'hit_into_play' WHEN 4 THEN 'hit_into_play' ELSE 'called_strike' END AS what, nullif(l_partkey % 15, 0) AS zone,
['ground_ball', 'line_drive', 'fly_ball', 'popup', '', '', ''][(l_orderkey + l_linenumber) % 7 + 1] AS kind, l_linenumber % 3 <> 0 AS counted, CAST(CASE WHEN CAST(l_quantity AS BIGINT) % 4 = 0 THEN 0.0 ELSE 0.9 END AS DOUBLE) AS woba, CASE WHEN CAST(l_quantity AS BIGINT) % 5 > 0 THEN l_quantity / 50 END AS xwoba,
CASE WHEN l_partkey % 11 > 0 THEN 60 + l_quantity END AS ev, l_quantity - 20 AS la, l_orderkey % 7 AS class, CASE WHEN l_partkey % 13 > 0 THEN degrees(atan2(100 + l_quantity - 125.42, 198.27 - 150)) END AS angle, l_linenumber % 3 AS stand, l_orderkey % 10 = 3 AS homer, l_orderkey % 2 AS babip, 80 + l_quantity / 4 AS velo FROM lineitem),
f AS (SELECT *, what IN ('swinging_strike', 'foul', 'hit_into_play') AS swing, what = 'swinging_strike' AS whiff, coalesce(zone BETWEEN 1 AND 9, false) AS inside, coalesce(zone >= 11, false) AS outside, what = 'hit_into_play' OR kind <> '' AS play,
coalesce(CASE WHEN stand = 1 THEN angle > 15 ELSE angle < -15 END, false) AS side, CASE WHEN type IN ('FF', 'SI') THEN 'fastball' WHEN type = 'SL' THEN 'breaking' WHEN type = 'CH' THEN 'offspeed' ELSE 'other' END AS grp FROM p)"""
_PARTS = {
    "pitches": "1", "swings": "swing", "whiffs": "whiff", "zone_pitches": "inside", "zone_swings": "inside AND swing", "zone_whiffs": "inside AND whiff", "chase_pitches": "outside", "chase_swings": "outside AND swing", "bip": "play", "hard_hit": "play AND ev >= 95", "barrels": "play AND class = 6",
    "ev_sum": "CASE WHEN play THEN coalesce(ev, 0.0) ELSE 0.0 END", "ev_n": "play AND ev IS NOT NULL", "la_sum": "CASE WHEN play THEN la ELSE 0.0 END", "la_n": "play", "gb": "kind = 'ground_ball'", "ld": "kind = 'line_drive'", "fb": "kind = 'fly_ball'", "pu": "kind = 'popup'", "pulled": "play AND side", "pulled_air": "play AND side AND kind IN ('line_drive', 'fly_ball')",
    "woba_value": "CASE WHEN counted THEN woba ELSE 0.0 END", "xwoba_value": "CASE WHEN counted THEN coalesce(xwoba, woba) ELSE 0.0 END", "woba_den": "counted",
}


def _part_sum(part: str) -> str:
    return f"sum({part})" if part.startswith("CASE") else f"CAST(sum(CAST(coalesce(CAST({part} AS BOOLEAN), false) AS INTEGER)) AS BIGINT)"


_PART_SUMS = ", ".join(f"{f'round({_part_sum(v)}, 4)' if v.startswith('CASE') else _part_sum(v)} AS {k}" for k, v in _PARTS.items())


def _pitches(spark, sf_dir) -> DataFrame:
    li = t(spark, sf_dir, "lineitem")
    k, n, p, q = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"))
    pick = lambda values, i: F.get(F.array(*[F.lit(v) for v in values]), i.cast("int"))
    raw = {
        "zone": F.when(p % 15 > 0, p % 15), "woba_denom": F.when(n % 3 > 0, "1"), "woba_value": F.when(q.cast("long") % 4 > 0, F.lit(0.9)), "estimated_woba_using_speedangle": F.when(q.cast("long") % 5 > 0, (q / 50).cast("string")).otherwise("null"), "launch_speed": F.when(p % 11 > 0, (60 + q).cast("string")).otherwise(""),
        "launch_angle": q - 20, "launch_speed_angle": k % 7, "hc_x": 100 + q, "hc_y": F.when(p % 13 > 0, F.lit(150)), "stand": F.when(n % 3 == 1, "L").when(n % 3 == 2, "R"), "babip_value": k % 2, "bb_type": pick(["ground_ball", "line_drive", "fly_ball", "popup", "", "", ""], (k + n) % 7),
        "description": F.lit("hit_into_play"), "pitch_type": F.when((k + p) % 6 == 4, "SI"), "release_speed": F.when(k % 2 == 0, (80 + q / 4).cast("string")),
    }
    return li.select(
        F.lit("g").alias("game_pk"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("dt"), F.concat(F.lit("p"), (p % 50).cast("string")).alias("pitcher_id"), F.concat(F.lit("b"), F.col("l_suppkey").cast("string")).alias("batter_id"), pick(["FF", "SL", "CH", "XX", "", ""], (k + p) % 6).alias("pitch_type"),
        pick(["swinging_strike", "foul", "ball", "hit_into_play", "", "called_strike"], k % 6).alias("description"), F.when(k % 2 == 1, 80 + q / 4).alias("release_speed"), F.when(k % 10 == 3, "home_run").otherwise("single").alias("events"), F.to_json(F.struct(*[v.alias(c) for c, v in raw.items()])).alias("raw_json"),
    )


def _features(spark, sf_dir, name: str) -> DataFrame:
    return pf.feature_tables(pf.pitch_components(_pitches(spark, sf_dir)))[name]


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 4).alias(c) if kind == "double" else c for c, kind in df.dtypes])


@query(f"WITH {_PITCH} SELECT dt, pitcher AS player_id, type AS pitch_type, {_PART_SUMS}, round(sum(velo), 4) AS velo_sum, count(*) AS velo_n FROM f WHERE type <> '' GROUP BY ALL")
def P25_pitch_components(spark, sf_dir):
    return _rounded(_features(spark, sf_dir, "feature_pitch_daily").drop("spin_sum", "spin_n", "league_code", "source"))


@query(f"WITH {_PITCH} SELECT dt, batter AS player_id, grp AS pitch_group, {_PART_SUMS} FROM f WHERE type <> '' GROUP BY ALL")
def A07_component_sums(spark, sf_dir):
    return _rounded(_features(spark, sf_dir, "feature_batter_pitch_daily").drop("league_code", "source"))


@query(f"""WITH {_PITCH} SELECT dt, batter AS player_id, round(sum(woba), 4) AS woba_value, round(sum(coalesce(xwoba, woba)), 4) AS xwoba_value, count(*) AS woba_den, count(*) FILTER (WHERE play AND xwoba IS NOT NULL) AS xwoba_bip_n,
count(*) FILTER (WHERE play AND NOT homer) AS bip, count(*) FILTER (WHERE play AND NOT homer AND babip > 0) AS babip_hits FROM f WHERE counted GROUP BY ALL""")
def A07_contact_sums(spark, sf_dir):
    return _rounded(_features(spark, sf_dir, "feature_contact_daily").drop("league_code", "source"))


@query(EV + " SELECT user_id, CASE WHEN dt >= '2024-01-15' THEN 'recent' ELSE 'early' END AS span, count(*) AS n, round(sum(value), 4) AS total FROM ev GROUP BY ALL")
def A08_spans(spark, sf_dir):
    span = F.when(F.col("dt") >= "2024-01-15", "recent").otherwise("early").alias("span")
    return events(spark, sf_dir).groupBy("user_id", span).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT user_id, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY user_id HAVING count(*) > 60 AND avg(value) > 40")
def A13_having(spark, sf_dir):
    return t(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.avg("value").alias("m")).where("n > 60 and m > 40").select("user_id", "n", F.round("m", 4).alias("mean"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def A14_duplicates(spark, sf_dir):
    return r.duplicate_groups(t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(EV + " SELECT count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers, min(dt) AS first_dt, max(dt) AS last_dt FROM ev")
def A15_distinct_counts(spark, sf_dir):
    return events(spark, sf_dir).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.count_distinct(F.when(F.col("event_type") == "purchase", F.col("user_id"))).alias("buyers"), F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt"))


@query("SELECT CAST(count(*) AS BIGINT) AS rows, sum(value) AS total FROM events WHERE value < -1")
def A11_empty_global(spark, sf_dir):
    return t(spark, sf_dir, "events").where("value < -1").agg(F.count("*").alias("rows"), F.sum("value").alias("total"))


@query(EV + """, g AS (SELECT user_id, dt, event_type, count(*) AS n, count(DISTINCT CAST(round(value) AS BIGINT)) AS kinds FROM ev GROUP BY ALL HAVING count(*) > 1)
SELECT count(*) FILTER (WHERE kinds = 1) AS identical, count(*) FILTER (WHERE kinds > 1) AS conflicting, CAST(coalesce(sum(n) - count(*), 0) AS BIGINT) AS extra_rows FROM g""")
def A18_dup_kinds(spark, sf_dir):
    e = events(spark, sf_dir).select("user_id", "dt", "event_type", F.round("value").cast("long").alias("v"))
    return r.duplicate_kinds(e, ["user_id", "dt", "event_type"])


@query("""SELECT 'p_brand' AS "column", round(avg(CASE WHEN p_brand IS NULL OR trim(p_brand) IN ('', '[]', '{}') THEN 1.0 ELSE 0.0 END), 6) AS null_rate FROM part UNION ALL SELECT 'p_size', round(avg(CASE WHEN p_size < 10 THEN 1.0 ELSE 0.0 END), 6) FROM part""")
def A19_null_rates(spark, sf_dir):
    p = t(spark, sf_dir, "part").withColumn("p_size", F.when(F.col("p_size") >= 10, F.col("p_size")))
    return r.null_rates(p, ["p_brand", "p_size"]).select("column", F.round("null_rate", 6).alias("null_rate"))


@query(EV + " SELECT dt, " + ", ".join(f"max(CASE WHEN event_type = '{e}' THEN value END) AS {e}" for e in ("click", "error", "purchase", "signup", "view")) + " FROM ev GROUP BY dt")
def A20_pivot(spark, sf_dir):
    return events(spark, sf_dir).groupBy("dt").pivot("event_type", ["click", "error", "purchase", "signup", "view"]).max("value")


@query(EV + ", f AS (SELECT event_type, dt, max(value) AS m FROM ev GROUP BY ALL HAVING max(value) > 480) SELECT event_type, string_agg(dt, ',' ORDER BY dt) AS days FROM f GROUP BY event_type")
def A22_failing_days(spark, sf_dir):
    checked = events(spark, sf_dir).groupBy(F.col("event_type").alias("check_name"), "dt").agg(F.when(F.max("value") > 480, "fail").otherwise("pass").alias("status"))
    return quality.failing_days(checked).select(F.col("check_name").alias("event_type"), "days")


@query("WITH o AS (SELECT l_orderkey, count(*) AS n, greatest(3, max(l_linenumber)) AS innings FROM lineitem GROUP BY 1) SELECT round(avg(CAST(n AS DOUBLE) * 9.0 / innings), 6) AS per_nine FROM o")
def A23_per_nine(spark, sf_dir):
    o = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.greatest(F.lit(3), F.max("l_linenumber")).alias("innings"))
    return o.agg(F.round(F.avg(F.col("n").cast("double") * 9.0 / F.col("innings")), 6).alias("per_nine"))


@query("SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 4) AS deviation FROM events GROUP BY 1")
def A25_mean_deviation(spark, sf_dir):
    return t(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev_pop("value"), 4).alias("deviation"))


@query("""WITH s AS (SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS rk FROM events)
SELECT round((sum(CASE WHEN y = 1 THEN rk END) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2.0) / (CAST(sum(y) AS DOUBLE) * sum(1 - y)), 9) AS auc, CAST(sum(y) AS BIGINT) AS positives, CAST(sum(1 - y) AS BIGINT) AS negatives FROM s""")
def A26_auc(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumn("y", (F.col("event_type") == "purchase").cast("int"))
    return r.tied_rank_auc(e, "value", "y").select(F.round("auc", 9).alias("auc"), "positives", "negatives")


_P = "1 / (1 + exp(-(0.004 * value - 1.2)))"


@query(f"WITH s AS (SELECT CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS y, {_P} AS p FROM events) SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS log_loss, round(avg((p - y) * (p - y)), 6) AS brier FROM s")
def A27_losses(spark, sf_dir):
    e = t(spark, sf_dir, "events").withColumns({"y": (F.col("event_type") == "purchase").cast("int"), "p": fx.sigmoid(F.col("value") * 0.004 - 1.2)})
    return ml.evaluate(e, "p", "y").select(F.round("log_loss", 6).alias("log_loss"), F.round("brier", 6).alias("brier"))


_SPLIT = "CASE WHEN dt <= '2024-01-08' THEN 'train' WHEN dt <= '2024-01-10' THEN 'embargo' WHEN dt <= '2024-01-18' THEN 'validation' WHEN dt <= '2024-01-20' THEN 'embargo' ELSE 'test' END"


@query(EV + f", s AS (SELECT *, {_SPLIT} AS split FROM ev) SELECT split, count(*) AS rows, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS positives, count(DISTINCT user_id) AS players, count(DISTINCT dt) AS days, min(dt) AS first_dt, max(dt) AS last_dt FROM s GROUP BY split")
def L04_split_summary(spark, sf_dir):
    s = ml.Splits("2024-01-10", "2024-01-20", 2)
    e = events(spark, sf_dir).withColumns({"split": ml.embargoed_split_of(F.col("dt"), s), "y": F.col("event_type") == "purchase", "player_id": F.col("user_id")})
    return ml.split_summary(e, "y")


@query(EV + f", p AS (SELECT count(DISTINCT dt) = 7 AS done FROM ev WHERE dt BETWEEN '2024-01-21' AND '2024-01-27'), u AS (SELECT user_id, sum(CASE WHEN dt <= '2024-01-20' THEN value END) / count(*) FILTER (WHERE dt <= '2024-01-20') AS base, count(*) FILTER (WHERE dt BETWEEN '2024-01-21' AND '2024-01-27') AS pa, sum(CASE WHEN dt BETWEEN '2024-01-21' AND '2024-01-27' THEN value END) / nullif(count(*) FILTER (WHERE dt BETWEEN '2024-01-21' AND '2024-01-27'), 0) AS later FROM ev GROUP BY user_id) SELECT user_id, CASE WHEN NOT done THEN 'pending' WHEN pa >= 10 AND later IS NOT NULL AND base IS NOT NULL THEN 'labeled' ELSE 'insufficient' END AS status, CASE WHEN done AND pa >= 10 THEN round(later - base, 4) >= 5 END AS breakout FROM u, p")
def L03_labels(spark, sf_dir):
    e = events(spark, sf_dir)
    later, base = F.col("dt").between("2024-01-21", "2024-01-27"), F.col("dt") <= "2024-01-20"
    u = e.groupBy("user_id").agg(fx.ratio(F.sum(F.when(base, F.col("value"))), F.count_if(base)).alias("base"), F.count_if(later).alias("pa"), fx.ratio(F.sum(F.when(later, F.col("value"))), F.count_if(later)).alias("later"))
    done = e.where(later).agg((F.count_distinct("dt") == 7).alias("done"))
    u = u.join(F.broadcast(done))
    enough = F.col("done") & (F.col("pa") >= 10)
    return u.select("user_id", F.when(~F.col("done"), "pending").when(enough & F.col("later").isNotNull() & F.col("base").isNotNull(), "labeled").otherwise("insufficient").alias("status"), F.when(enough, F.round(F.col("later") - F.col("base"), 4) >= 5).alias("breakout"))


@query(f"SELECT event_id, round({_P}, 6) AS score FROM events")
def L09_score(spark, sf_dir):
    model = ml.Model(["value"], [300.0], [1.0], [0.004], 0.0, 0.1)
    return t(spark, sf_dir, "events").withColumn("x_value", F.col("value")).select("event_id", F.round(model.score(), 6).alias("score"))


def _newton_sql(grid: Sequence[float], steps: int = 8) -> str:
    """Newton's method for an intercept and two standardised inputs, written out step by step; a step solves three equations."""
    ctes = ["x AS MATERIALIZED (SELECT CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END AS y, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS u, (hour(ts) - avg(hour(ts)) OVER ()) / stddev_pop(hour(ts)) OVER () AS v FROM events)"]
    for g, l2 in enumerate(grid):
        ctes.append(f"b{g}_0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c)")
        for i in range(steps):
            ctes.append(f"s{g}_{i} AS MATERIALIZED (SELECT any_value(a) AS a, any_value(b) AS b, any_value(c) AS c, sum(y - p) AS g0, sum((y - p) * u) - {l2} * any_value(b) AS g1, sum((y - p) * v) - {l2} * any_value(c) AS g2, sum(w) AS h00, sum(w * u) AS h01, sum(w * v) AS h02, sum(w * u * u) + {l2} AS h11, sum(w * u * v) AS h12, sum(w * v * v) + {l2} AS h22 FROM (SELECT *, p * (1 - p) AS w FROM (SELECT *, 1 / (1 + exp(-(a + b * u + c * v))) AS p FROM x, b{g}_{i})))")
            det = "(h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02))"
            ctes.append(f"b{g}_{i + 1} AS MATERIALIZED (SELECT a + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / {det} AS a, b + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / {det} AS b, c + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / {det} AS c FROM s{g}_{i})")
    rows = " UNION ALL ".join(f"SELECT {l2}::DOUBLE AS l2, unnest(['intercept', 'value', 'hour']) AS name, unnest([round(a, 4), round(b, 4), round(c, 4)]) AS coefficient FROM b{g}_{steps}" for g, l2 in enumerate(grid))
    return f"WITH {', '.join(ctes)} {rows}"


_GRID = [0.1, 10.0, 1000.0]


def _hours(spark, sf_dir) -> DataFrame:
    return t(spark, sf_dir, "events").withColumns({"y": (F.col("event_type") == "purchase").cast("int"), "x_value": F.col("value"), "x_hour": F.hour("ts").cast("double")})


def _coefficients(spark, models: Sequence[ml.Model]) -> DataFrame:
    rows = [(m.l2, n, round(b, 4)) for m in models for n, b in zip(["intercept", *m.inputs], [m.intercept, *m.coefficients], strict=True)]
    return spark.createDataFrame(rows, "l2 double, name string, coefficient double")


@query(_newton_sql([1.0]).replace("SELECT 1.0::DOUBLE AS l2, ", "SELECT "))
def L06_logistic_fit(spark, sf_dir):
    return _coefficients(spark, [ml.fit(_hours(spark, sf_dir), "y", ["value", "hour"], 1.0)]).drop("l2")


@query(_newton_sql(_GRID))
def L07_penalty_grid(spark, sf_dir):
    """The models of all penalties, fitted together."""
    return _coefficients(spark, ml.fit_grid(_hours(spark, sf_dir), "y", ["value", "hour"], _GRID))


@query("""WITH s AS (SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, unnest([{'name': 'recent_minus_base_woba', 's': value - 100.0}, {'name': 'base_woba_below_league', 's': -CAST(hour(ts) AS DOUBLE)}, {'name': 'home_runs_of_the_day', 's': CAST(event_id % 7 AS DOUBLE)}], recursive := true) FROM events),
r AS (SELECT *, rank() OVER (PARTITION BY name ORDER BY s) + (count(*) OVER (PARTITION BY name, s) - 1) / 2.0 AS rk FROM s)
SELECT name, round((sum(CASE WHEN y = 1 THEN rk END) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2.0) / (CAST(sum(y) AS DOUBLE) * sum(1 - y)), 9) AS auc, CAST(sum(y) AS BIGINT) AS positives, CAST(sum(1 - y) AS BIGINT) AS negatives FROM r GROUP BY name""")
def L10_heuristics(spark, sf_dir):
    """The areas under the curves of several rankings, in one pass."""
    e = t(spark, sf_dir, "events").select((F.col("event_type") == "purchase").alias("y"), F.col("value").alias("f_recent_woba"), F.lit(100.0).alias("f_base_woba"), F.hour("ts").alias("f_base_woba_vs_league"), (F.col("event_id") % 7).alias("f_day_hr"))
    return ml.heuristic_aucs(e, "y").select("name", F.round("auc", 9).alias("auc"), "positives", "negatives")


_ASOF = ml.Breakout(baseline_days=8, recent_days=3, label_days=5, min_baseline_pa=4, min_label_pa=2, margin_woba=0.05)
_ASOF_SPLITS = ml.Splits("2024-01-12", "2024-01-20", 5)


def _asof_lines(spark, sf_dir) -> DataFrame:
    """Users' days: values over a level as hits and so on."""
    e = events(spark, sf_dir)
    over = lambda v: F.count_if(F.col("value") > v)
    zero = F.lit(0).cast("long")
    made = {"pa": F.count("*"), "ab": over(10), "h": over(60), "doubles": over(100), "triples": over(150), "hr": over(200), "bb": over(20), "so": over(30), "woba_den": F.count("*"), "woba_value": F.round(F.sum("value") / 100, 6)}
    return e.groupBy("dt", F.col("user_id").alias("player_id"), F.when(F.col("user_id") % 3 == 0, "NPB").otherwise("MLB").alias("league_code")).agg(*[v.alias(k) for k, v in made.items()]).withColumns({"hbp": zero, "sf": zero, "sh": zero})


def _days_published(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).where("dt <> '2024-01-19'").select("dt").distinct()


def _asof_sum(column: str, first: int, last: int) -> str:
    return f"coalesce(sum(CASE WHEN CAST(l.dt AS DATE) - CAST(d.dt AS DATE) BETWEEN {first} AND {last} THEN {column} END), 0)"


@query(EV + f""", l AS (SELECT dt, user_id AS player_id, CASE WHEN user_id % 3 = 0 THEN 'NPB' ELSE 'MLB' END AS league_code, count(*) AS pa, count(*) FILTER (WHERE value > 10) AS ab, count(*) FILTER (WHERE value > 60) AS h, count(*) FILTER (WHERE value > 100) AS doubles, count(*) FILTER (WHERE value > 150) AS triples, count(*) FILTER (WHERE value > 200) AS hr,
count(*) FILTER (WHERE value > 20) AS bb, count(*) FILTER (WHERE value > 30) AS so, CAST(round(sum(value) / 100, 6) AS DECIMAL(38, 6)) AS woba_value FROM ev GROUP BY ALL), p AS (SELECT DISTINCT dt FROM ev WHERE dt <> '2024-01-19'), d AS (SELECT dt FROM p WHERE dt BETWEEN '2024-01-05' AND '2024-01-26'),
w AS (SELECT d.dt, player_id, league_code, {_asof_sum("pa", -7, 0)} AS base_pa, {_asof_sum("so", -7, 0)} AS base_so, {_asof_sum("bb", -7, 0)} AS base_bb, {_asof_sum("ab", -7, 0)} AS base_ab, {_asof_sum("h", -7, 0)} AS base_h, {_asof_sum("hr", -7, 0)} AS base_hr, {_asof_sum("doubles + 2 * triples + 3 * hr", -7, 0)} AS extra, {_asof_sum("1", -7, 0)} AS base_days,
CAST({_asof_sum("woba_value", -7, 0)} AS DOUBLE) AS base_value, {_asof_sum("pa", -2, 0)} AS recent_pa, CAST({_asof_sum("woba_value", -2, 0)} AS DOUBLE) AS recent_value, {_asof_sum("hr", 0, 0)} AS day_hr, {_asof_sum("pa", 1, 5)} AS label_pa, CAST({_asof_sum("woba_value", 1, 5)} AS DOUBLE) AS label_value
FROM d JOIN l ON CAST(l.dt AS DATE) - CAST(d.dt AS DATE) BETWEEN -7 AND 5 GROUP BY ALL), g AS (SELECT *, round(sum(base_value) OVER n / sum(base_pa) OVER n, 6) AS league, (SELECT count(*) FROM p WHERE CAST(p.dt AS DATE) - CAST(w.dt AS DATE) BETWEEN 1 AND 5) = 5 AS done FROM w WINDOW n AS (PARTITION BY dt, league_code)),
r AS (SELECT *, round(base_value / base_pa, 6) AS base_woba, CASE WHEN label_pa > 0 THEN round(label_value / label_pa, 6) END AS label_woba FROM g WHERE base_pa >= 4)
SELECT dt, player_id, league_code, CAST(base_pa AS BIGINT) AS f_base_pa, base_woba AS f_base_woba, round(base_so / CAST(base_pa AS DOUBLE), 6) AS f_base_k_rate, round(base_bb / CAST(base_pa AS DOUBLE), 6) AS f_base_bb_rate, round(extra / nullif(CAST(base_ab AS DOUBLE), 0), 6) AS f_base_iso, CASE WHEN base_ab - base_so - base_hr > 0 THEN round((base_h - base_hr) / CAST(base_ab - base_so - base_hr AS DOUBLE), 6) END AS f_base_babip,
CAST(base_days AS BIGINT) AS f_base_days, CAST(recent_pa AS BIGINT) AS f_recent_pa, CASE WHEN recent_pa > 0 THEN round(recent_value / recent_pa, 6) END AS f_recent_woba, league AS f_league_base_woba, CAST(day_hr AS BIGINT) AS f_day_hr, CASE WHEN NOT done THEN 'pending' WHEN label_pa >= 2 AND label_woba IS NOT NULL THEN 'labeled' ELSE 'insufficient_pa' END AS label_status,
CASE WHEN done THEN CAST(label_pa AS BIGINT) END AS label_pa, CASE WHEN done AND label_pa >= 2 AND label_woba IS NOT NULL THEN round(label_woba - base_woba, 6) >= 0.05 - 1e-9 END AS label_breakout, CASE WHEN dt <= '2024-01-07' THEN 'train' WHEN dt <= '2024-01-12' THEN 'embargo' WHEN dt <= '2024-01-15' THEN 'validation' WHEN dt <= '2024-01-20' THEN 'embargo' ELSE 'test' END AS split FROM r""")
def L01_example_range(spark, sf_dir):
    """Features and labels of every published day of a range, by prefix sums in one pass."""
    found = ml.example_range(_asof_lines(spark, sf_dir), _days_published(spark, sf_dir), "2024-01-05", "2024-01-26", _ASOF, _ASOF_SPLITS)
    rates = ["f_base_woba", "f_base_k_rate", "f_base_bb_rate", "f_base_iso", "f_base_babip", "f_recent_woba", "f_league_base_woba"]
    return found.select("dt", "player_id", "league_code", "f_base_pa", *rates, "f_base_days", "f_recent_pa", "f_day_hr", "label_status", "label_pa", "label_breakout", "split")


# Publishing ---------------------------------------------------------------------------------------------

@query("""WITH p AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders), c AS (SELECT dt FROM p WHERE dt LIKE '%-06-13'), f AS (SELECT substr(dt, 1, 4) AS y, min(dt) AS dt FROM c GROUP BY 1),
b AS (SELECT DISTINCT p.dt FROM p JOIN c ON CAST(p.dt AS DATE) - CAST(c.dt AS DATE) BETWEEN -4 AND 5) SELECT unnest(['fact_plate_appearance', 'run_expectancy_daily', 'feature_batter_daily']) AS table_name, dt FROM c
UNION ALL SELECT 'run_expectancy', p.dt FROM p JOIN f ON substr(p.dt, 1, 4) = f.y AND p.dt >= f.dt UNION ALL SELECT unnest(['ml_breakout', 'ml_breakout_score']), dt FROM b""")
def D05_affected_days(spark, sf_dir):
    """Every table's days that follow from plate appearances that changed on the 13th of each June."""
    days = t(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt")).distinct()
    changed = days.where(F.col("dt").endswith("-06-13")).select(F.lit("fact_plate_appearance").alias("table_name"), "dt")
    return publish.affected_rows(changed, days, publish.derived_tables(6, 4, {}))


@query(EV + """, d AS (SELECT dt, CAST(event_id % 8 AS BIGINT) AS base_state, CAST(event_id % 3 AS BIGINT) AS outs, count(*) AS n, sum(CAST(floor(value) AS BIGINT) % 5 + CASE WHEN dt = '2024-01-10' THEN 1 ELSE 0 END) AS r FROM ev GROUP BY ALL), p AS (SELECT DISTINCT dt FROM ev), f AS (SELECT base_state, outs, min(dt) AS first FROM d GROUP BY ALL)
SELECT p.dt, f.base_state, f.outs, CAST(sum(coalesce(n, 0)) OVER w AS BIGINT) AS pa_count, CAST(sum(coalesce(r, 0)) OVER w AS BIGINT) AS runs FROM f JOIN p ON p.dt >= f.first LEFT JOIN d ON d.dt = p.dt AND d.base_state = f.base_state AND d.outs = f.outs WINDOW w AS (PARTITION BY f.base_state, f.outs ORDER BY p.dt)""")
def D07_range_publish(spark, sf_dir):
    """Run expectancy as it is published after one day changed: that day and the season after it are written again."""
    e = events(spark, sf_dir)
    pas = lambda more: e.select("dt", F.lit("mlb_statcast").alias("source"), (F.col("event_id") % 8).alias("base_state_before"), (F.col("event_id") % 3).alias("outs_before"), (F.floor("value").cast("long") % 5 + more).alias("runs_to_end_of_inning"))
    builds = {
        "run_expectancy_daily": lambda read, days: gold.run_expectancy_daily(read("fact_plate_appearance").where(F.col("dt").isin(days))),
        "run_expectancy": lambda read, days: gold.run_expectancy(read("run_expectancy_daily").drop("ingested_at_utc"), read("fact_plate_appearance").select("dt").distinct()),
    }
    tables = [tb for tb in publish.derived_tables(30, 14, builds) if tb.name in builds]
    root = f"{spark.conf.get('spark.sql.warehouse.dir').removeprefix('file:')}/range-{uuid.uuid4().hex}"
    days = sorted(r.dt for r in e.select("dt").distinct().collect())
    lake.write_days(pas(0), root, "fact_plate_appearance", days)
    publish.publish(spark, root, tables, {"fact_plate_appearance": days}, days)
    lake.write_days(pas(1).where("dt = '2024-01-10'"), root, "fact_plate_appearance", ["2024-01-10"])
    publish.publish(spark, root, tables, {"fact_plate_appearance": ["2024-01-10"]}, days)
    return lake.read(spark, root, "run_expectancy").select("dt", F.col("base_state").cast("long").alias("base_state"), F.col("outs").cast("long").alias("outs"), "pa_count", "runs")


# Scalars, silver shapes ---------------------------------------------------------------------------------

@query("SELECT c_custkey, CAST(round(((4 + c_custkey % 3) * 12 + c_custkey % 12) * 2.54, 1) AS DOUBLE) AS height_cm, round(CAST(150 + c_custkey % 90 AS DOUBLE) * 0.45359237, 1) AS weight_kg FROM customer")
def P05_measures(spark, sf_dir):
    k = F.col("c_custkey")
    height = F.format_string("%d' %d\"", 4 + k % 3, k % 12)
    return t(spark, sf_dir, "customer").select("c_custkey", sv.height_cm(height).cast("double").alias("height_cm"), sv.weight_kg((150 + k % 90).cast("string")).alias("weight_kg"))


@query("SELECT 'g' || n_regionkey AS game_id, CASE WHEN n_nationkey % 2 = 0 THEN 'h' ELSE 'a' END AS team_id, 'p' || n_nationkey AS player_id, CAST(n_nationkey AS BIGINT) AS ab, CAST(n_nationkey % 4 AS BIGINT) AS h, CAST(NULL AS BIGINT) AS rbi FROM nation WHERE n_nationkey > 0")
def P07_map_values(spark, sf_dir):
    """Box scores, whose players are the values of a map by id; who didn't bat has no line."""
    k = F.col("n_nationkey")
    line = F.struct(F.struct(F.concat(F.lit("p"), k.cast("string")).alias("id")).alias("person"), F.struct(F.struct(k.cast("string").alias("atBats"), (k % 4).alias("hits"), F.lit("-").alias("rbi")).alias("batting")).alias("stats"))
    n = t(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("game")).agg(*[F.map_from_entries(F.collect_list(F.when(k % 2 == odd, F.struct(F.concat(F.lit("ID"), k.cast("string")), line)))).alias(side) for side, odd in (("home", 0), ("away", 1))])
    team = lambda side: F.struct(F.struct(F.lit("h" if side == "home" else "a").alias("id")).alias("team"), F.col(side).alias("players")).alias(side)
    body = n.select(F.lit("2024-05-01").alias("dt"), F.to_json(F.struct(F.concat(F.lit("g"), F.col("game").cast("string")).alias("gamePk"), F.struct(team("home"), team("away")).alias("teams"))).alias("body_text"))
    return sv.mlb_boxscore(body, "batting").select("game_id", "team_id", "player_id", "ab", "h", "rbi")


@query("SELECT vec_id, CAST(i AS INTEGER) AS nth, round(embedding[i + 1], 4) AS a, CASE WHEN i < 3 THEN round(embedding[i + 5], 4) END AS b FROM embeddings, range(4) g(i)")
def P14_zip_arrays(spark, sf_dir):
    e = t(spark, sf_dir, "embeddings").select("vec_id", F.slice("embedding", 1, 4).alias("a"), F.slice("embedding", 5, 3).alias("b"))
    z = sv.zipped_rows(e, "a", "b")
    return z.select("vec_id", "nth", F.round("a", 4).alias("a"), F.round("b", 4).alias("b"))


@query("SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS era, o_orderstatus AS ip FROM orders")
def P15_header_map(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", F.array(F.lit(" IP "), F.lit("NAME"), F.lit("ERA")).alias("h"), F.array("o_orderstatus", F.lit("x"), F.col("o_custkey").cast("string")).alias("c"))
    return sv.by_header(o, "h", "c", {"era": "ERA", "ip": "IP"})


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS game_date, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '18:30' END AS game_time FROM orders")
def P08_dates(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    return o.select("o_orderkey", fx.iso_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("game_date"), fx.clock(F.when(F.col("o_orderkey") % 3 == 0, "183").otherwise("1830")).alias("game_time"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS whole, CASE WHEN p_partkey % 5 = 1 THEN CAST(p_size AS DOUBLE) + 0.5 WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS number FROM part WHERE p_partkey % 5 <> 1 UNION ALL SELECT p_partkey, NULL, CAST(p_size AS DOUBLE) + 0.5 FROM part WHERE p_partkey % 5 = 1")
def P18_null_safe_casts(spark, sf_dir):
    kind = F.col("p_partkey") % 5
    text = F.when(kind == 0, "n/a").when(kind == 1, F.concat(F.col("p_size").cast("string"), F.lit(".5"))).otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string")))
    return t(spark, sf_dir, "part").select("p_partkey", fx.to_long(text).cast("int").alias("whole"), fx.to_double(text).alias("number"))


_KINDS = "['strikeout_double_play', 'sac_fly_double_play', 'grounded_into_double_play', 'double', 'home_run', 'intent_walk', 'field_error', 'field_out', 'truncated_pa', 'catcher_interf', 'fielders_choice_out', 'sac_bunt', 'triple_play', 'single', 'hit_by_pitch', 'other']"
_CODES = "['K', 'SF', 'DP', '2B', 'HR', 'BB', 'ERROR', 'OUT', 'TRUNCATED', 'INT', 'FC', 'SH', 'TP', '1B', 'HBP', 'UNKNOWN']"


@query(f"SELECT p_partkey, {_CODES}[CAST(p_partkey % 16 AS INTEGER) + 1] AS code FROM part")
def X03_ordered_case(spark, sf_dir):
    import ast

    kinds = F.array(*[F.lit(k) for k in ast.literal_eval(_KINDS)])
    return t(spark, sf_dir, "part").select("p_partkey", fx.event_code(F.get(kinds, (F.col("p_partkey") % 16).cast("int"))).alias("code"))


@query("SELECT p_partkey, ['SH', 'K', '3B', 'OUT', 'HR', 'BB', 'SF', 'UNKNOWN'][CAST(p_partkey % 8 AS INTEGER) + 1] AS code, CASE WHEN p_partkey % 8 IN (0, 3) THEN 1 END AS outs FROM part")
def X06_phrases(spark, sf_dir):
    texts = ["3球目:送りバント成功 1アウト二塁", "６球目：空振り三振", "三塁打 一三塁", "送りバント失敗 １アウト", "本塁打", "四球", "犠飛 得点", "不明"]
    text = F.get(F.array(*[F.lit(x) for x in texts]), (F.col("p_partkey") % 8).cast("int"))
    return t(spark, sf_dir, "part").select("p_partkey", fx.result_code(text).alias("code"), fx.outs_in_text(text).cast("int").alias("outs"))


@query("SELECT o_orderkey, CAST((o_orderkey % 2) + 2 * (o_custkey % 2) + 4 * (o_custkey % 3 = 0)::INT AS BIGINT) AS bases FROM orders")
def X11_base_bits(spark, sf_dir):
    on = lambda c: F.when(c, "id")
    o = t(spark, sf_dir, "orders")
    return o.select("o_orderkey", fx.bases_from_ids(on(F.col("o_orderkey") % 2 == 1), on(F.col("o_custkey") % 2 == 1), on(F.col("o_custkey") % 3 == 0)).alias("bases"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS o FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, (o // 3) || '.' || (o % 3) AS ip, CAST(o AS INTEGER) AS outs FROM l""")
def M_ip_text(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").withColumn("ip", fx.outs_to_innings(F.col("l_quantity").cast("long")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "ip", fx.innings_to_outs("ip").alias("outs"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def X19_json(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'regular' WHEN n_nationkey % 4 = 1 THEN 'postseason' WHEN n_nationkey % 4 = 2 THEN 'unknown' ELSE 'other' END AS phase, n_nationkey % 3 <> 2 AS final FROM nation""")
def X21_phases(spark, sf_dir):
    k = F.col("n_nationkey") % 4
    kind = F.when(k == 0, "セ・リーグ公式戦").when(k == 1, "SMBC日本シリーズ2026").when(k == 3, "ファーム")
    status = F.when(F.col("n_nationkey") % 3 == 0, "Final").when(F.col("n_nationkey") % 3 == 1, "Completed Early: Rain").otherwise("Postponed")
    return t(spark, sf_dir, "nation").select("n_nationkey", fx.season_phase(kind, F.lit("npb_spaia")).alias("phase"), fx.is_final(status).alias("final"))


# Semantic layer -----------------------------------------------------------------------------------------

_STAR = "WITH s AS (SELECT l.*, c_mktsegment AS segment, n_name AS nation, CAST(o_orderdate AS DATE) AS day FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"


def _star(spark, sf_dir) -> Callable[[str], DataFrame]:
    views = {
        "lines": lambda: t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("day", F.to_date("o_orderdate")),
        "customers": lambda: t(spark, sf_dir, "customer").join(t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")),
    }
    return lambda name: views[name]()


STAR_VIEW = {"mv_lines": sem.MetricView("lines", {"segment": sem.Dimension("segment", "customer.c_mktsegment"), "nation": sem.Dimension("nation", "customer.n_name"), "returned": sem.Dimension("returned", "l_returnflag"), "day": sem.Dimension("day", "day", "date")}, {"customer": sem.Join("customers", "o_custkey", "c_custkey")}, "day", [("returned", "in", ["R", "A"])])}
STAR_METRICS = {
    "lines": sem.Metric("mv_lines", lambda: F.count("*"), "count", "lines"),
    "quantity": sem.Metric("mv_lines", lambda: F.round(F.sum("l_quantity"), 4), "decimal", "quantity"),
    "price_per_unit": sem.Metric("mv_lines", lambda: F.round(F.sum("l_extendedprice") / F.nullif(F.sum("l_quantity"), F.lit(0.0)), 4), "decimal", "price by quantity"),
}


@query(_STAR + " SELECT segment, nation, count(*) AS lines, round(sum(l_extendedprice) / nullif(sum(l_quantity), 0), 4) AS unit_price FROM s WHERE nation <> 'nothing' AND day BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND l_returnflag IN ('R', 'A') GROUP BY ALL HAVING count(*) > 3")
def C_metric_request(spark, sf_dir):
    req = sem.MetricRequest(["lines", "price_per_unit"], ["segment", "nation"], [("nation", "ne", "nothing")], ("1995-01-01", "1996-12-31"), [("lines", "gt", 3)], names={"price_per_unit": "unit_price"})
    return sem.compile_request(req, _star(spark, sf_dir), STAR_METRICS, STAR_VIEW)


@query("SELECT l_returnflag AS returned, count(*) AS lines, round(sum(l_quantity), 4) AS quantity FROM lineitem GROUP BY 1 ORDER BY lines DESC NULLS LAST LIMIT 2")
def O01_order_and_limit(spark, sf_dir):
    req = sem.MetricRequest(["lines", "quantity"], ["returned"], [("returned", "not_null", None)], order=[("lines", "desc")], most=2)
    return sem.compile_request(req, _star(spark, sf_dir), STAR_METRICS, STAR_VIEW)


@query("SELECT count(*) AS lines, round(sum(l_quantity), 4) AS quantity FROM lineitem WHERE l_returnflag = 'x'' OR 1=1 --'")
def F01_values_are_data(spark, sf_dir):
    req = sem.MetricRequest(["lines", "quantity"], [], [("returned", "eq", "x' OR 1=1 --")])
    return sem.compile_request(req, _star(spark, sf_dir), STAR_METRICS, STAR_VIEW)


@query("""WITH f AS (SELECT user_id, count(*) AS pa, count(*) FILTER (WHERE event_type <> 'view') AS ab, count(*) FILTER (WHERE event_type IN ('purchase', 'click')) AS h, count(*) FILTER (WHERE event_type = 'view') AS bb, sum(CASE event_type WHEN 'purchase' THEN 4 WHEN 'click' THEN 1 ELSE 0 END) AS tb FROM events GROUP BY 1)
SELECT user_id, round(h / nullif(CAST(ab AS DOUBLE), 0), 6) AS avg, round((h + bb) / nullif(CAST(ab + bb AS DOUBLE), 0), 6) AS obp, round(tb / nullif(CAST(ab AS DOUBLE), 0), 6) AS slg FROM f""")
def M_ratio_metrics(spark, sf_dir):
    e = F.col("event_type")
    flags = {"is_ab": e != "view", "is_hit": e.isin("purchase", "click"), "is_bb": e == "view", "is_hbp": F.lit(False), "is_sf": F.lit(False)}
    pas = t(spark, sf_dir, "events").withColumns({k: v.cast("int") for k, v in flags.items()}).withColumn("total_bases", F.when(e == "purchase", 4).when(e == "click", 1).otherwise(0))
    view = {"mv_batting": sem.MetricView("v", {"user_id": sem.Dimension("user_id", "user_id")})}
    out = sem.compile_request(sem.MetricRequest(["avg", "obp", "slg"], ["user_id"]), lambda _: pas, metric_views=view)
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in ("avg", "obp", "slg")])


@query("SELECT c_custkey, c_name FROM customer WHERE contains(lower(c_name), '00001')")
def F05_contains(spark, sf_dir):
    c = t(spark, sf_dir, "customer").withColumn("dt", F.lit("2024-01-01"))
    return sem.table_rows(c, every_day=True, contains={"c_name": "00001"}, columns=["c_custkey", "c_name"])


@query("SELECT r_name, count(*) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def E_guarded_sql(spark, sf_dir):
    for name in ("region", "nation"):
        t(spark, sf_dir, name).createOrReplaceTempView(name)
    return sem.query(spark, "SELECT r_name, count(*) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")


# Insights -----------------------------------------------------------------------------------------------

@query(EV + """, u AS (SELECT user_id, count(*) FILTER (WHERE dt >= '2024-01-17') AS n1, count(*) FILTER (WHERE dt < '2024-01-17') AS n0, sum(CASE WHEN dt >= '2024-01-17' THEN value END) AS v1, sum(CASE WHEN dt < '2024-01-17' THEN value END) AS v0 FROM ev WHERE dt <= '2024-01-30' GROUP BY 1)
SELECT user_id, round(abs((v1 / n1 - v0 / n0) / (80.0 * sqrt(1.0 / n1 + 1.0 / n0))), 3) AS score, n1 AS sample_size FROM u WHERE n1 >= 10 AND n0 >= 10""")
def I02_z_scores(spark, sf_dir):
    """Changes against a baseline, as candidates."""
    daily = events(spark, sf_dir).select("dt", F.col("user_id").cast("string").alias("player_id"), F.lit("MLB").alias("league_code"), F.lit(1).alias("pa"), F.col("value").alias("woba_value"), F.lit(1).alias("woba_den"))
    found = insights.change_vs_baseline(daily, "2024-01-30", {"recent_days": 14, "min_recent_pa": 10, "min_baseline_pa": 10, "min_abs_z": 0.0, "woba_sd_per_pa": 80.0})
    return found.select(F.col("subject_id").cast("long").alias("user_id"), "score", "sample_size")


@query(EV + """, w AS (SELECT event_type, CAST((day(ts) - 1) // 10 AS INTEGER) AS part, count(*) AS n, count(*) FILTER (WHERE value > 100) AS x FROM ev GROUP BY ALL), l AS (SELECT *, lag(n) OVER o AS pn, lag(x) OVER o AS px, lead(n) OVER o IS NULL AS newest FROM w WINDOW o AS (PARTITION BY event_type ORDER BY part))
SELECT event_type, round((CAST(x AS DOUBLE) / n - CAST(px AS DOUBLE) / pn) / sqrt(greatest((CAST(x + px AS DOUBLE) / (n + pn)) * (1 - CAST(x + px AS DOUBLE) / (n + pn)) * (1.0 / n + 1.0 / pn), 1e-12)), 4) AS z FROM l WHERE newest AND pn IS NOT NULL""")
def I03_month_shift(spark, sf_dir):
    part = F.floor((F.dayofmonth("ts") - 1) / 10).cast("int").alias("part")
    w = events(spark, sf_dir).groupBy("event_type", part).agg(F.count("*").alias("n"), F.count_if(F.col("value") > 100).alias("x"))
    o = Window.partitionBy("event_type").orderBy("part")
    pairs = w.withColumns({"pn": F.lag("n").over(o), "px": F.lag("x").over(o), "newest": F.lead("n").over(o).isNull()}).where("newest and pn is not null")
    return pairs.select("event_type", F.round(fx.proportion_z(F.col("x"), F.col("n"), F.col("px"), F.col("pn")), 4).alias("z"))


_LEVELS = {"so": 100, "bb": 50, "hr": 200}


def _level_days(rows: DataFrame) -> DataFrame:
    """Daily lines of event types as leagues: values beyond a level as strikeouts, walks and home runs."""
    return rows.groupBy(F.col("event_type").alias("league_code"), "dt").agg(F.count("*").alias("pa"), *[F.count_if(F.col("value") > v).alias(c) for c, v in _LEVELS.items()])


_RATE_ROWS = """unnest([{'m': 'k_rate', 'x': count(*) FILTER (WHERE value > 100)}, {'m': 'bb_rate', 'x': count(*) FILTER (WHERE value > 50)}, {'m': 'hr_rate', 'x': count(*) FILTER (WHERE value > 200)}], recursive := true)"""
_RATE_Z = "abs((CAST(a.x AS DOUBLE) / a.n - CAST(b.x AS DOUBLE) / b.n) / sqrt(greatest((CAST(a.x + b.x AS DOUBLE) / (a.n + b.n)) * (1 - CAST(a.x + b.x AS DOUBLE) / (a.n + b.n)) * (1.0 / a.n + 1.0 / b.n), 1e-12)))"


@query(f"""WITH s AS (SELECT event_type, count(*) AS n, {_RATE_ROWS} FROM events GROUP BY 1)
SELECT a.event_type || '-' || b.event_type AS pair, a.m AS metric, round({_RATE_Z}, 3) AS score FROM s a JOIN s b ON a.event_type < b.event_type AND a.m = b.m""")
def I04_pairs(spark, sf_dir):
    found = insights.cross_league_gap(_level_days(events(spark, sf_dir)), "2024-12-31", {"min_season_pa": 1, "min_abs_z": 0.0})
    return found.select(F.col("subject_id").alias("pair"), "metric", "score")


@query(f"""WITH s AS (SELECT event_type, (day(ts) - 1) // 10 AS part, count(*) AS n, {_RATE_ROWS} FROM events GROUP BY 1, 2), o AS (SELECT *, dense_rank() OVER (PARTITION BY event_type ORDER BY part DESC) AS back FROM s)
SELECT a.event_type AS league, a.m AS metric, round({_RATE_Z}, 3) AS score FROM o a JOIN o b ON a.event_type = b.event_type AND a.m = b.m AND a.back = 1 AND b.back = 2""")
def W14_league_shift(spark, sf_dir):
    month = F.concat(F.lit("2024-0"), (F.floor((F.dayofmonth("ts") - 1) / 10) + 1).cast("string"), F.lit("-01"))
    found = insights.league_month_shift(_level_days(events(spark, sf_dir).withColumn("dt", month)), "2024-12-31", {"min_month_pa": 1, "min_abs_z": 0.0})
    return found.select(F.col("subject_id").alias("league"), "metric", "score")


def _statistics_sql(sides: str, keys: str, only: Iterable[str] = (), offset: str = "0") -> str:
    """z of each statistic of a relation with since_ and before_ sums; ``keys`` are its key columns."""
    rows = []
    for i, st in enumerate(dr.STATISTICS):
        if only and st.name not in only:
            continue
        m1, m2 = f"CAST(since_{st.top} AS DOUBLE) / since_{st.bottom}", f"CAST(before_{st.top} AS DOUBLE) / before_{st.bottom}"
        pooled = f"(CAST(since_{st.top} + before_{st.top} AS DOUBLE) / (since_{st.bottom} + before_{st.bottom}))"
        spread = f"sqrt(greatest({pooled} * (1 - {pooled}), 1e-9))" if st.kind == dr.PROPORTION else str(st.spread)
        rows.append(f"SELECT {keys}, {offset} + {i} AS nth, '{st.name}' AS metric, round({m1}, {st.places}) AS since, round({m2}, {st.places}) AS before, round(({m1} - {m2}) / ({spread} * sqrt(1.0 / since_{st.bottom} + 1.0 / before_{st.bottom})), 2) AS z FROM {sides} WHERE since_{st.bottom} >= {st.least} AND before_{st.bottom} >= {st.least}")
    return " UNION ALL ".join(rows)


def _side_sums(when: str) -> str:
    return ", ".join(f"coalesce(sum(CASE WHEN {on} THEN {f'({v})' if v.startswith('CASE') else f'CAST(coalesce(CAST({v} AS BOOLEAN), false) AS INTEGER)'} END), 0) AS {side}_{k}" for side, on in (("since", when), ("before", f"NOT ({when})")) for k, v in _PARTS.items())


_AS_OF, _SPLIT_DAY = "1995-12-31", "1995-07-01"
_SEASON = f"FROM f WHERE type <> '' AND dt BETWEEN '1995-01-01' AND '{_AS_OF}'"
_CLEAREST = "SELECT {keys}, metric, since, before, z, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY abs(z) DESC, nth) AS INTEGER) AS rank FROM z WHERE abs(z) >= 0.5 QUALIFY rank <= 3"


@query(f"""WITH {_PITCH}, a AS (SELECT batter, {_side_sums(f"dt >= '{_SPLIT_DAY}'")} {_SEASON} GROUP BY batter), g AS (SELECT batter, grp, {_side_sums(f"dt >= '{_SPLIT_DAY}'")} {_SEASON} AND grp <> 'other' GROUP BY ALL),
z AS (SELECT batter, nth, metric, since, before, z FROM ({_statistics_sql('a', 'batter')}) UNION ALL SELECT batter, nth, grp || '_' || metric, since, before, z FROM ({_statistics_sql('g', 'batter, grp', dr.BY_GROUP, "CASE grp WHEN 'fastball' THEN 100 WHEN 'breaking' THEN 200 ELSE 300 END")}))
{_CLEAREST.format(keys="batter")}""")
def I08_drivers(spark, sf_dir):
    """Batters' changes since a day, overall and by pitch group."""
    features = _features(spark, sf_dir, "feature_batter_pitch_daily")
    splits = t(spark, sf_dir, "supplier").select(F.concat(F.lit("b"), F.col("s_suppkey").cast("string")).alias("player_id"), F.lit(_SPLIT_DAY).alias("since"))
    found = dr.clearest(dr.batter_change(features, splits, _AS_OF, 1000, 0.0).drop("rank"), ["player_id"], 3, 0.5)
    return found.select(F.col("player_id").alias("batter"), "metric", "since", "before", "z", "rank")


@query(f"""WITH {_PITCH}, o AS (SELECT batter, {", ".join(f"sum(CAST(coalesce(({v}), 0) AS DOUBLE)) AS {k}" if v.startswith("CASE") else f"sum(CAST(coalesce(CAST({v} AS BOOLEAN), false) AS INTEGER)) AS {k}" for k, v in _PARTS.items())} {_SEASON} GROUP BY batter),
s AS (SELECT batter, {", ".join(f"{k} AS since_{k}, sum({k}) OVER () AS before_{k}" for k in _PARTS)} FROM o), z AS ({_statistics_sql("s", "batter", dr.VS_LEAGUE)}) {_CLEAREST.format(keys="batter")}""")
def I08_against_league(spark, sf_dir):
    features = _features(spark, sf_dir, "feature_batter_pitch_daily")
    found = dr.clearest(dr.batter_vs_league(features, features.select("player_id"), _AS_OF, 1000, 0.0).drop("rank"), ["player_id"], 3, 0.5)
    return found.select(F.col("player_id").alias("batter"), "metric", "since", "before", "z", "rank")


@query(f"""WITH {_PITCH}, a AS (SELECT pitcher, {_side_sums(f"dt >= '{_SPLIT_DAY}'")} {_SEASON} GROUP BY pitcher), n AS (SELECT pitcher, {_side_sums("type = 'SL'")} {_SEASON} AND dt >= '{_SPLIT_DAY}' GROUP BY pitcher),
z AS ({_statistics_sql("a", "pitcher", dr.OF_PITCHER)} UNION ALL SELECT pitcher, nth, 'new_pitch_' || metric, since, before, z FROM ({_statistics_sql("n", "pitcher", dr.OF_PITCH, "100")})) {_CLEAREST.format(keys="pitcher")}""")
def I08_pitchers(spark, sf_dir):
    features = _features(spark, sf_dir, "feature_pitch_daily")
    splits = features.select("player_id").distinct().select("player_id", F.lit(_SPLIT_DAY).alias("since"), F.lit("SL").alias("pitch_type"))
    found = dr.clearest(dr.pitcher_change(features, splits, _AS_OF, 1000, 0.0).drop("rank"), ["player_id"], 3, 0.5)
    return found.select(F.col("player_id").alias("pitcher"), "metric", "since", "before", "z", "rank")


_WOBA_DAYS = EV + """, d AS (SELECT dt, user_id AS player, count(*) AS pa, round(sum(value) / 100, 6) AS v FROM ev GROUP BY ALL),
s AS (SELECT player, sum(pa) FILTER (WHERE dt >= '2024-01-17') AS n1, sum(v) FILTER (WHERE dt >= '2024-01-17') AS v1, sum(pa) FILTER (WHERE dt < '2024-01-17') AS n0, sum(v) FILTER (WHERE dt < '2024-01-17') AS v0 FROM d WHERE dt <= '2024-01-30' GROUP BY 1),
c AS (SELECT player, round(v1 / n1, 4) AS value, round(v0 / n0, 4) AS baseline FROM s WHERE n1 >= 10 AND n0 >= 10 AND abs((v1 / n1 - v0 / n0) / (0.5 * sqrt(1.0 / n1 + 1.0 / n0))) >= 0.3)"""


def _change_candidates(spark, sf_dir) -> tuple[DataFrame, dict[str, DataFrame]]:
    e = events(spark, sf_dir)
    zero = F.lit(0).cast("long")
    daily = e.groupBy("dt", F.col("user_id").cast("string").alias("player_id")).agg(F.count("*").alias("pa"), F.count_if(F.col("value") > 60).alias("h"), F.round(F.sum("value") / 100, 6).alias("woba_value")).withColumns({"league_code": F.lit("MLB"), "woba_den": F.col("pa"), "so": zero, "bb": zero, "hr": zero})
    found = insights.change_vs_baseline(daily, "2024-01-30", {"recent_days": 14, "min_recent_pa": 10, "min_baseline_pa": 10, "min_abs_z": 0.3, "woba_sd_per_pa": 0.5})
    return found, {evidence.BATTER: daily}


@query(_WOBA_DAYS + " SELECT CAST(player AS VARCHAR) AS subject_id, value + CASE WHEN player % 3 = 0 THEN 0.01 ELSE 0 END AS value, CAST(2 AS BIGINT) AS checks, CAST(CASE WHEN player % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS wrong, player % 3 <> 0 AS verified FROM c")
def I09_evidence(spark, sf_dir):
    """All candidates' numbers made again in one aggregate; every third states a wrong one."""
    found, sources = _change_candidates(spark, sf_dir)
    off = F.col("subject_id").cast("long") % 3 == 0
    stated = found.withColumn("evidence", F.transform("evidence", lambda p: p.withField("expected", p["expected"] + F.when(off & (p["role"] == "value"), 0.01).otherwise(0.0))))
    told = stated.select("insight_id", "subject_id", (F.col("value") + F.when(off, 0.01).otherwise(0.0)).alias("value"))
    return told.join(evidence.verified(stated, sources), "insight_id").drop("insight_id")


@query(_WOBA_DAYS + """, n AS (SELECT *, c_name AS name FROM c LEFT JOIN customer ON c_custkey = player) SELECT CAST(player AS VARCHAR) AS subject_id, name AS subject_name,
list_filter([CASE WHEN player % 4 = 1 THEN 'number not in the evidence: 0.9999' END, CASE WHEN name IS NULL THEN 'subject not in the evidence: nobody' END, CASE WHEN player % 4 = 2 THEN 'no hashtags' END], lambda x: x IS NOT NULL) AS problems FROM n""")
def I11_finding_checks(spark, sf_dir):
    """Posts about candidates: a wrong number, an unknown name and a hashtag are found."""
    found, sources = _change_candidates(spark, sf_dir)
    players = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("player_id"), F.col("c_name").alias("primary_name"))
    known = evidence.named(found.withColumn("rank", F.lit(1)), players)
    kind, name = F.col("subject_id").cast("long") % 4, F.coalesce("subject_name", F.lit("nobody"))
    # names end in digits, which are no statement: posts name subjects without them
    plain = known.withColumn("subject_name", F.regexp_replace("subject_name", "#.*", ""))
    number = F.when(kind == 1, "0.9999").otherwise(F.col("value").cast("decimal(38,4)").cast("string"))  # a double's text may have an exponent
    post = F.concat(F.regexp_replace(name, "#.*", ""), F.lit(" stands at "), number, F.when(kind == 2, " #wow").otherwise(""))
    posts = known.select("subject_id", "subject_name", F.col("insight_id").alias("finding_id"), post.alias("post"), F.array(F.regexp_replace(name, "#.*", "")).alias("subjects"), F.array("insight_id").alias("cites"))
    return evidence.check_findings(posts, plain, evidence.verified(found, sources)).select("subject_id", "subject_name", "problems")


# Quality ------------------------------------------------------------------------------------------------

@query("""WITH d AS (SELECT count(*) AS v FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)), f AS (SELECT count(*) AS v FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)), g AS (SELECT count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.08) AS v FROM lineitem)
SELECT 'unique:orders' AS check_name, CASE WHEN v = 0 THEN 'pass' ELSE 'fail' END AS status, CAST(v AS DOUBLE) AS value FROM d UNION ALL SELECT 'references:lines', CASE WHEN v = 0 THEN 'pass' ELSE 'fail' END, CAST(v AS DOUBLE) FROM f UNION ALL SELECT 'range:discount', CASE WHEN v = 0 THEN 'pass' ELSE 'fail' END, CAST(v AS DOUBLE) FROM g UNION ALL
SELECT 'coverage:orders', CASE WHEN least(1.0, CAST(a AS DOUBLE) / b) >= 0.5 THEN 'pass' ELSE 'fail' END, round(least(1.0, CAST(a AS DOUBLE) / b), 6) FROM (SELECT (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS a, (SELECT count(DISTINCT o_orderkey) FROM orders) AS b)""")
def G01_checks(spark, sf_dir):
    o, li = t(spark, sf_dir, "orders"), t(spark, sf_dir, "lineitem")
    checks = [
        quality.uniqueness(o, "orders", ["o_orderkey"]),
        quality.referential_integrity(li, o, "lines", "l_orderkey", "o_orderkey"),
        quality.value_range(li, "discount", "l_discount", 0, 0.08),
        quality.coverage(li.select("l_orderkey"), o.select(F.col("o_orderkey").alias("l_orderkey")), "orders", "l_orderkey", 0.5),
    ]
    return quality.union(checks).select("check_name", "status", F.round("value", 6).alias("value"))


@query("SELECT event_type, count(*) AS rows FROM events WHERE event_type NOT IN ('signup', 'view', 'click') GROUP BY 1")
def G15_unknown_codes(spark, sf_dir):
    return quality.unknown_codes(t(spark, sf_dir, "events"), "event_type", ["signup", "view", "click"])


@query("SELECT user_id AS c_2b, CAST(event_id AS VARCHAR) AS a_b FROM events")
def K10_publishable_names(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(F.col("user_id").alias("2b"), F.col("event_id").cast("string").alias("a b"))
    return lake.publishable(e)


_MEASURED = [
    checks.Measure("orders", "orders"), checks.Measure("repeated", "orders", checks.repeats("o_custkey")), checks.Measure("open", "orders", where="o_orderstatus = 'O'"),
    checks.Measure("lines", "lines"), checks.Measure("returned", "lines", where="l_returnflag = 'R'"), checks.Measure("cheap", "lines", "min(l_quantity)", empty="cast(null as double)"),
]
_CHECKED = [
    checks.Check("lines without orders", "lines", "orders > 0", "lines > 0"), checks.Check("one order a customer", "repeated", "repeated = 0"), checks.Check("returned share", "returned / nullif(lines, 0)", "returned / nullif(lines, 0) <= 0.5", "lines > 0", checks.SOFT),
    checks.Check("smallest line", "cheap", "cheap >= 1", "lines > 0"), checks.Check("days with orders", "count_if(orders > 0)", "count_if(orders > 0) > 30", whole=True),
]


def _dated_tables(spark, sf_dir) -> dict[str, DataFrame]:
    dated = lambda name, c: t(spark, sf_dir, name).withColumn("dt", F.date_format(c, "yyyy-MM-dd"))
    return {"orders": dated("orders", "o_orderdate").where("o_orderkey % 3 > 0"), "lines": dated("lineitem", "l_shipdate")}


@query("""WITH o AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt, count(*) AS orders, count(o_custkey) - count(DISTINCT o_custkey) AS repeated FROM orders WHERE o_orderkey % 3 > 0 GROUP BY 1), l AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS dt, count(*) AS lines, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, min(l_quantity) AS cheap FROM lineitem GROUP BY 1),
d AS (SELECT dt, coalesce(orders, 0) AS orders, coalesce(repeated, 0) AS repeated, coalesce(lines, 0) AS lines, coalesce(returned, 0) AS returned, cheap FROM o FULL JOIN l USING (dt) WHERE dt BETWEEN '1994-01-01' AND '1995-12-31')
SELECT dt, 'lines without orders' AS check_name, 'hard' AS severity, CAST(lines AS DOUBLE) AS value, CASE WHEN lines = 0 THEN 'skip' WHEN orders > 0 THEN 'pass' ELSE 'fail' END AS status FROM d UNION ALL SELECT dt, 'one order a customer', 'hard', repeated, CASE WHEN repeated = 0 THEN 'pass' ELSE 'fail' END FROM d
UNION ALL SELECT dt, 'returned share', 'soft', CASE WHEN lines > 0 THEN CAST(returned AS DOUBLE) / lines END, CASE WHEN lines = 0 THEN 'skip' WHEN CAST(returned AS DOUBLE) / lines <= 0.5 THEN 'pass' ELSE 'fail' END FROM d UNION ALL SELECT dt, 'smallest line', 'hard', cheap, CASE WHEN lines = 0 THEN 'skip' WHEN cheap >= 1 THEN 'pass' ELSE 'fail' END FROM d
UNION ALL SELECT NULL, 'days with orders', 'hard', count(*) FILTER (WHERE orders > 0), CASE WHEN count(*) FILTER (WHERE orders > 0) > 30 THEN 'pass' ELSE 'fail' END FROM d""")
def G10_compiled_checks(spark, sf_dir):
    """Declared checks of every day of two tables, by one aggregate a table."""
    return checks.run(checks.by_day(_dated_tables(spark, sf_dir), _MEASURED, "1994-01-01", "1995-12-31"), _CHECKED)


@query("SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS dt FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') NOT IN (SELECT strftime(o_orderdate, '%Y-%m-%d') FROM orders WHERE o_orderkey % 3 > 0)")
def J16_dates_without_games(spark, sf_dir):
    """Days of lines without orders, from the measures of days; no rows are joined."""
    daily = checks.by_day(_dated_tables(spark, sf_dir), [m for m in _MEASURED if m.name in ("orders", "lines")], "0000", "9999")
    return checks.run(daily, _CHECKED[:1]).where("status = 'fail'").select("dt")


@query("""WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS dt FROM events) SELECT 'events' AS table_name, unnest([{'measure': 'days', 'value': CAST(count(DISTINCT dt) AS DOUBLE)}, {'measure': 'rows', 'value': CAST(count(*) AS DOUBLE)}, {'measure': 'repeated', 'value': CAST(count(*) - count(DISTINCT (dt, user_id, event_type)) AS DOUBLE)},
{'measure': 'first_dt', 'value': CAST(CAST(min(dt) AS DATE) - DATE '1970-01-01' AS DOUBLE)}, {'measure': 'last_dt', 'value': CAST(CAST(max(dt) AS DATE) - DATE '1970-01-01' AS DOUBLE)}, {'measure': 'null:props', 'value': round(avg(CASE WHEN props IS NULL OR trim(props) IN ('', '[]', '{}') THEN 1.0 ELSE 0.0 END), 6)}, {'measure': 'null:kind', 'value': round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 6)}], recursive := true) FROM e""")
def G11_silver_audit(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("kind", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")))
    found = checks.silver_audit({"events": (e, ["user_id", "event_type"], ["props", "kind"])})
    return found.select("table_name", "measure", F.round("value", 6).alias("value"))


# State machine, features and further shapes --------------------------------------------------------------

_TRACKED = """p AS (SELECT user_id AS g, event_id // 7 AS ab, event_id % 7 AS pn, (event_id // 70) % 9 AS inning, CASE WHEN (event_id // 35) % 2 = 0 THEN 'Top' ELSE 'Bot' END AS half, (event_id // 7) % 3 AS outs, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN value > 50 THEN 2 ELSE 0 END AS bases,
CASE event_type WHEN 'purchase' THEN '1B' WHEN 'view' THEN 'OUT' WHEN 'click' THEN 'K' WHEN 'error' THEN 'DP' ELSE 'UNKNOWN' END AS code, event_id % 5 AS score FROM events)"""


def _tracked(spark, sf_dir) -> DataFrame:
    e = t(spark, sf_dir, "events")
    i = F.col("event_id")
    whole = lambda n: F.floor(i / n).cast("long")
    event = fx.first_match([(F.col("event_type") == k, v) for k, v in (("purchase", "single"), ("view", "field_out"), ("click", "strikeout"), ("error", "grounded_into_double_play"))], "")
    return e.select(
        F.col("user_id").cast("string").alias("game_pk"), whole(7).alias("at_bat_number"), (i % 7).alias("pitch_number"), (whole(70) % 9).alias("inning"), F.when(whole(35) % 2 == 0, "Top").otherwise("Bot").alias("inning_topbot"), (whole(7) % 3).alias("outs_when_up"),
        F.when(i % 2 == 0, "x").alias("on_1b"), F.when(F.col("value") > 50, "y").alias("on_2b"), F.lit(None).cast("string").alias("on_3b"), event.alias("events"), F.lit(None).cast("string").alias("batter_id"), F.lit(None).cast("string").alias("pitcher_id"),
        F.format_string('{"bat_score": %d, "post_bat_score": %d}', i % 5, i % 5 + 1).alias("raw_json"), F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )


@query(f"""WITH {_TRACKED}, a AS (SELECT g, ab, arg_min(p, pn) AS f, arg_max(p, pn) AS z FROM p GROUP BY g, ab), n AS (SELECT *, lead(f) OVER (PARTITION BY g ORDER BY ab) AS x FROM a),
s AS (SELECT *, x IS NOT NULL AND x.inning = f.inning AND x.half = f.half AS same FROM n),
c AS (SELECT *, CASE WHEN z.code = 'UNKNOWN' AND NOT same AND f.outs = 2 THEN 'TRUNCATED' ELSE z.code END AS event_type FROM s),
o AS (SELECT *, CASE WHEN x IS NULL AND event_type = 'TRUNCATED' THEN 3 WHEN x IS NULL THEN least(3, f.outs + CASE event_type WHEN 'K' THEN 1 WHEN 'OUT' THEN 1 WHEN 'DP' THEN 2 ELSE 0 END) WHEN same THEN x.outs ELSE 3 END AS outs_after FROM c)
SELECT {id_sql("'game:mlb_statsapi:' || g")} AS game_id, ab AS play_order, event_type, f.outs AS outs_before, CAST(outs_after AS BIGINT) AS outs_after, CAST(f.bases AS BIGINT) AS base_before, CAST(CASE WHEN x IS NULL THEN CASE WHEN outs_after = 3 THEN 0 END WHEN same THEN x.bases ELSE 0 END AS BIGINT) AS base_after,
CASE WHEN same THEN x.score ELSE z.score + 1 END - f.score AS runs FROM o""")
def T01_plate_appearances(spark, sf_dir):
    bridge = spark.createDataFrame([], gold.BRIDGE)
    pas = plays.from_pitches(_tracked(spark, sf_dir), bridge)
    return pas.select("game_id", "play_order", "event_type", "outs_before", "outs_after", F.col("base_state_before").alias("base_before"), F.col("base_state_after").alias("base_after"), F.col("runs_scored_on_play").alias("runs"))


_SPANS = EV + ", s AS (SELECT user_id, event_type, count(*) FILTER (WHERE dt < '2024-01-16') AS early_n, count(*) FILTER (WHERE dt >= '2024-01-16') AS recent_n, sum(CASE WHEN dt < '2024-01-16' THEN value ELSE 0 END) AS early_v, sum(CASE WHEN dt >= '2024-01-16' THEN value ELSE 0 END) AS recent_v FROM ev GROUP BY ALL)"


def _thrown(spark, sf_dir) -> DataFrame:
    """Events as pitches of their type."""
    return events(spark, sf_dir).select("dt", F.col("user_id").cast("string").alias("player_id"), F.col("event_type").alias("pitch_type"), F.lit(1).alias("pitches"), (F.col("value") > 20).cast("int").alias("swings"), (F.col("value") > 100).cast("int").alias("whiffs"), F.col("value").alias("velo_sum"), F.lit(1).alias("velo_n"), F.col("value").alias("xwoba_value"), F.lit(1).alias("woba_den"))


@query(_SPANS + " SELECT CAST(user_id AS VARCHAR) AS player_id, event_type AS pitch_type, CAST(early_n AS BIGINT) AS early_pitches, CAST(recent_n AS BIGINT) AS recent_pitches, round(early_v, 4) AS early_velo_sum, round(recent_v, 4) AS recent_velo_sum FROM s")
def A08_pitcher_spans(spark, sf_dir):
    """Sums of two spans side by side."""
    s = insights.pitcher_spans(_thrown(spark, sf_dir), "2024-01-30", 15)
    return s.select("player_id", "pitch_type", "early_pitches", "recent_pitches", *[F.round(c, 4).alias(c) for c in ("early_velo_sum", "recent_velo_sum")])


@query(_SPANS + """, x AS (SELECT user_id, count(*) FILTER (WHERE dt < '2024-01-16' AND value > 20) AS s0, count(*) FILTER (WHERE dt >= '2024-01-16' AND value > 20) AS s1 FROM ev GROUP BY 1), w AS (SELECT *, sum(early_n) OVER p AS e, sum(recent_n) OVER p AS r FROM s WINDOW p AS (PARTITION BY user_id))
SELECT CAST(user_id AS VARCHAR) AS player_id, 'pitch_share:' || event_type AS metric, round(CAST(recent_n AS DOUBLE) / r, 4) AS value, round(CAST(early_n AS DOUBLE) / e, 4) AS baseline FROM w JOIN x USING (user_id) WHERE e >= 1 AND r >= 1 AND s0 > 0 AND s1 > 0 AND early_n * 5 <= e AND recent_n * 10 >= r * 3""")
def I06_pitch_shares(spark, sf_dir):
    """Pitches that were rare and are no more, as candidates."""
    limits = {"recent_days": 15, "min_early_pitches": 1, "min_recent_pitches": 1, "max_early_share": 0.2, "min_recent_share": 0.3, "min_xwoba_improvement": -1e9}
    found = insights.new_pitch(_thrown(spark, sf_dir), "2024-01-30", limits)
    return found.select(F.col("subject_id").alias("player_id"), "metric", "value", "baseline")


@query(_SPANS + " SELECT CAST(user_id AS VARCHAR) AS player_id, 'velo:' || event_type AS metric, round(recent_v / recent_n - early_v / early_n, 4) AS change FROM s WHERE event_type IN ('click', 'view') AND early_n >= 3 AND recent_n >= 3 AND abs(recent_v / recent_n - early_v / early_n) >= 15")
def I07_velocity_change(spark, sf_dir):
    found = insights.velocity_change(_thrown(spark, sf_dir), "2024-01-30", {"recent_days": 15, "pitch_types": ["click", "view"], "min_pitches": 3, "min_abs_mph": 15})
    return found.select(F.col("subject_id").alias("player_id"), "metric", F.col("delta").alias("change"))


@query("SELECT user_id AS player_id, round(sum(value) / count(*) - sum(least(value, 100)) / count(*), 4) AS gap FROM events GROUP BY user_id HAVING count(*) >= 20 AND abs(sum(value) / count(*) - sum(least(value, 100)) / count(*)) >= 4")
def I05_luck_gap(spark, sf_dir):
    c = events(spark, sf_dir).select("dt", F.col("user_id").alias("player_id"), F.col("value").alias("woba_value"), F.least("value", F.lit(100.0)).alias("xwoba_value"), F.lit(1.0).alias("woba_den"), F.lit(1).alias("bip"), F.lit(0).alias("babip_hits"), F.lit(1).alias("xwoba_bip_n"))
    found = insights.luck_gap(c, "2024-12-31", {"min_pa": 20, "min_abs_gap": 4.0})
    return found.select(F.col("subject_id").alias("player_id"), F.col("delta").alias("gap"))


@query("SELECT CASE WHEN c_custkey % 4 = 0 THEN 'player:source:s:' || c_custkey WHEN c_custkey % 4 = 1 THEN 'player:name:' || lower(c_name) || ':1990-01-01' WHEN c_custkey % 4 = 2 THEN 'player:name:' || lower(c_name) || ':team' END AS key, CASE c_custkey % 4 WHEN 0 THEN 0.9 WHEN 1 THEN 0.75 WHEN 2 THEN 0.5 END::DOUBLE AS confidence, c_custkey FROM customer")
def N02_match_cascade(spark, sf_dir):
    k = F.col("c_custkey") % 4
    rows = t(spark, sf_dir, "customer").select("c_custkey", F.lit("s").alias("source"), F.when(k == 0, F.col("c_custkey").cast("string")).alias("source_id"), F.col("c_name").alias("name"), F.when(k == 1, "1990-01-01").alias("dob"), F.when(k == 2, "team").alias("team"))
    return rows.withColumn("m", gold.match_key("player")).select("c_custkey", "m.key", "m.confidence")


@query("SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(p_size AS BIGINT) AS whole FROM part")
def K11_aligned(spark, sf_dir):
    p = t(spark, sf_dir, "part").select("p_partkey", "p_size", F.col("p_size").cast("double").alias("whole"))
    return lake.aligned(p, {"p_size": "bigint", "whole": "bigint"})


@query(EV + " SELECT event_type AS league_code, substr(dt, 1, 7) AS month, count(*) AS pa, CAST(sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS BIGINT) AS so FROM ev GROUP BY ALL")
def A09_league_months(spark, sf_dir):
    d = events(spark, sf_dir).select("dt", F.col("event_type").alias("league_code"), F.lit(1).alias("pa"), (F.col("value") > 100).cast("int").alias("so"), F.lit(0).alias("bb"), F.lit(0).alias("hr"))
    return insights.league_months(d, "2024-12-31").select("league_code", "month", "pa", "so")


@query("SELECT 'region' AS name, count(*) AS rows FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part")
def A16_row_counts(spark, sf_dir):
    counts = [t(spark, sf_dir, n).agg(F.lit(n).alias("name"), F.count("*").alias("rows")) for n in ("region", "nation", "supplier", "part")]
    return quality.union(counts)


@query("""WITH pa AS (SELECT l_orderkey AS game_id, l_linenumber % 2 = 0 AS top, count(*) FILTER (WHERE l_returnflag <> 'A') AS pa, CAST(sum(CAST(l_quantity AS BIGINT) % 3) AS BIGINT) AS runs, count(*) FILTER (WHERE l_returnflag = 'R') AS hits FROM lineitem GROUP BY ALL),
truth AS (SELECT o_orderkey AS game_id, side = 1 AS top, o_orderkey % 4 AS pa, o_custkey % 5 AS runs, o_orderkey % 3 AS hits FROM orders, range(2) g(side))
SELECT game_id, top AS is_top_inning, coalesce(pa.pa = t.pa, false) AS pa_match, coalesce(pa.runs = t.runs, false) AS runs_match, coalesce(pa.hits = t.hits, false) AS hits_match FROM truth t LEFT JOIN pa USING (game_id, top)""")
def A24_reconcile(spark, sf_dir):
    """Lines as plate appearances against totals that the orders state."""
    pas = t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("game_id"), (F.col("l_linenumber") % 2 == 0).alias("is_top_inning"), F.when(F.col("l_returnflag") == "A", "TRUNCATED").when(F.col("l_returnflag") == "R", "1B").otherwise("OUT").alias("event_type"), (F.col("l_quantity").cast("long") % 3).alias("runs_scored_on_play"), F.lit("d").alias("dt"))
    o = t(spark, sf_dir, "orders")
    truth = o.select(F.col("o_orderkey").alias("game_id"), F.explode(F.array(F.lit(True), F.lit(False))).alias("is_top_inning"), (F.col("o_orderkey") % 4).alias("pa"), (F.col("o_custkey") % 5).alias("runs"), (F.col("o_orderkey") % 3).alias("hits"))
    games = o.select(F.col("o_orderkey").alias("game_id"), F.lit("d").alias("dt"))
    return quality.reconcile(pas, games, truth).select("game_id", "is_top_inning", "pa_match", "runs_match", "hits_match")


@query("SELECT n_nationkey, ['Bases empty', '1st', '2nd', '1st & 2nd', '3rd', '1st & 3rd', '2nd & 3rd', 'Loaded'][n_nationkey % 8 + 1] AS runners FROM nation")
def V08_labels(spark, sf_dir):
    n = t(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey") % 8).alias("base_state"), F.lit("2024-01-01").alias("dt"))
    return sem.v_run_expectancy_daily({"run_expectancy_daily": n}).select("n_nationkey", "runners")


@query(EV + " SELECT event_id, CASE WHEN dt <= '2024-01-10' THEN 'train' WHEN dt <= '2024-01-20' THEN 'validation' ELSE 'test' END AS split FROM ev WHERE value <= 200 AND event_id % 4 < 3")
def V09_training_rows(spark, sf_dir):
    e = events(spark, sf_dir).withColumns({"source": F.lit("mlb_statcast"), "base_state_before": F.lit(0), "outs_before": (F.col("event_id") % 4).cast("int"), "runs_to_end_of_inning": F.when(F.col("value") <= 200, 1)})
    split = e.select("dt").distinct().withColumn("split", ml.split_of(F.col("dt"), ml.Splits("2024-01-10", "2024-01-20", 2)))
    return sem.v_re_training({"fact_plate_appearance": e, "ml_split": split}).select("event_id", "split")


@query("SELECT c_mktsegment AS segment, count(*) AS players, round(sum(c_acctbal), 2) AS total, round(max(c_acctbal), 2) AS best FROM customer GROUP BY 1")
def E09_dashboard_totals(spark, sf_dir):
    return t(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("players"), F.round(F.sum("c_acctbal"), 2).alias("total"), F.round(F.max("c_acctbal"), 2).alias("best"))


assert gold_queries  # registers its queries, too


def queries() -> dict[str, Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
