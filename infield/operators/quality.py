"""Data quality: checks as DataFrames of (check, severity, status, value, threshold), enforcement, audits, reconciliation."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from infield.functions import columns as fx
from infield.operators.relational import orphans

HARD, SOFT = "hard", "soft"


def result(df: DataFrame, check: str, severity: str, value: Column, threshold: float, passed: Column, skipped: Column | None = None) -> DataFrame:
    status = F.when(passed, "pass").otherwise("fail")
    status = status if skipped is None else F.when(skipped, "skip").otherwise(status)
    return df.select(F.lit(check).alias("check_name"), F.lit(severity).alias("severity"), status.alias("status"), value.cast("double").alias("value"), F.lit(float(threshold)).alias("threshold"))


def uniqueness(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    bad = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("v"))
    return result(bad, f"unique:{name}", HARD, F.col("v"), 0, F.col("v") == 0)


def referential_integrity(child: DataFrame, parent: DataFrame, name: str, child_key: str, parent_key: str) -> DataFrame:
    bad = orphans(child, parent, child_key, parent_key).agg(F.count("*").alias("v"))
    return result(bad, f"references:{name}", HARD, F.col("v"), 0, F.col("v") == 0)


def value_range(df: DataFrame, name: str, column: str, low: float, high: float) -> DataFrame:
    bad = df.agg(F.count_if((F.col(column) < low) | (F.col(column) > high)).alias("v"))
    return result(bad, f"range:{name}", HARD, F.col("v"), 0, F.col("v") == 0)


def least_rows(df: DataFrame, name: str, least: int, scheduled: DataFrame | None = None) -> DataFrame:
    """At least ``least`` rows; passes without any where no game was ``scheduled``, and is skipped where all were called off."""
    counted = df.agg(F.count("*").alias("v"))
    if scheduled is None:
        return result(counted, f"rows:{name}", HARD, F.col("v"), least, F.col("v") >= least)
    off = F.lower(F.coalesce("status", F.lit(""))).rlike("postponed|cancel|中止|취소")
    games = scheduled.agg(F.count("*").alias("games"), F.count_if(off).alias("off"))
    both = counted.join(F.broadcast(games))
    return result(both, f"rows:{name}", HARD, F.col("v"), least, (F.col("v") >= least) | (F.col("games") == 0), skipped=(F.col("games") > 0) & (F.col("games") == F.col("off")) & (F.col("v") < least))


def coverage(covered: DataFrame, wanted: DataFrame, name: str, key: str, least: float) -> DataFrame:
    """Distinct covered keys by distinct wanted ones, at most 1; skipped where none is wanted."""
    a = covered.agg(F.count_distinct(key).alias("a"))
    both = a.join(F.broadcast(wanted.agg(F.count_distinct(key).alias("b"))))
    share = F.least(F.lit(1.0), fx.ratio("a", "b"))
    return result(both, f"coverage:{name}", SOFT, share, least, F.coalesce(share >= least, F.lit(False)), skipped=F.col("b") == 0)


def schema_changes(now: DataFrame, before_json: str) -> list[str]:
    """Columns added, dropped or retyped since the schema of the latest day strictly before."""
    old = {f["name"]: f["type"] for f in json.loads(before_json)["fields"]}
    new = {f["name"]: f["type"] for f in json.loads(now.schema.json())["fields"]}
    return sorted([f"+{c}" for c in new.keys() - old.keys()] + [f"-{c}" for c in old.keys() - new.keys()] + [f"~{c}" for c in new.keys() & old.keys() if new[c] != old[c]])


def union(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def enforce(results: DataFrame) -> list[str]:
    """Names of soft failures; raises for hard ones, after all checks have run."""
    failed = results.where("status = 'fail'").select("check_name", "severity").collect()  # a row a check
    hard = sorted(r.check_name for r in failed if r.severity == HARD)
    if hard:
        raise ValueError("failed checks: " + ", ".join(hard))
    return sorted(r.check_name for r in failed)


def reconcile(pas: DataFrame, games: DataFrame, truth: DataFrame) -> DataFrame:
    """Plate appearances, runs and hits of each game and side against the truth (game_id, is_top_inning, pa, runs, hits)."""
    real = F.coalesce(F.col("event_type") != "TRUNCATED", F.lit(True))
    ours = pas.join(games.select("game_id", "dt").distinct(), ["game_id", "dt"], "left_semi").groupBy("game_id", "is_top_inning").agg(F.count_if(real).alias("pa"), F.sum("runs_scored_on_play").alias("runs"), F.count_if(F.col("event_type").isin(*fx.HITS)).alias("hits"))
    both = truth.select("game_id", "is_top_inning", *[F.col(c).alias("true_" + c) for c in ("pa", "runs", "hits")]).join(ours, ["game_id", "is_top_inning"], "left")
    return both.withColumns({f"{c}_match": F.coalesce(F.col(c) == F.col("true_" + c), F.lit(False)) for c in ("pa", "runs", "hits")})


def stage_audit(stage: str, started: str, seconds: float, rows: int, status: str) -> dict:
    return {"stage": stage, "started_at_utc": started, "seconds": round(seconds, 3), "rows": rows, "status": status}


def failing_days(results: DataFrame) -> DataFrame:
    """For each check the failing days as one text."""
    return results.where("status = 'fail'").groupBy("check_name").agg(F.concat_ws(",", F.sort_array(F.collect_set("dt"))).alias("days"))


def unmapped_game_types(games: DataFrame) -> DataFrame:
    phase = fx.season_phase("game_type", "source")
    return games.groupBy("source", "game_type", phase.alias("season_phase")).agg(F.count("*").alias("games")).where("season_phase = 'other'")


def unknown_codes(df: DataFrame, column: str, known: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*known)).groupBy(column).agg(F.count("*").alias("rows"))
