"""Plate appearances: from tracked pitches, from play-by-play text and from play files, with runs to the end of the inning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from infield.functions import columns as fx
from infield.operators.relational import filled_forward, ordinal_suffix, segments, suffix_sum

PA = [
    "pa_id", "game_id", "inning", "is_top_inning", "batting_team_id", "fielding_team_id", "batter_id", "pitcher_id", "event_type", "rbi", "runs_scored_on_play",
    "outs_on_play", "base_state_before", "outs_before", "base_state_after", "outs_after", "dt", "source", "play_order",
]


def with_entity(df: DataFrame, bridge: DataFrame, entity: str, source: str, column: str, out: str) -> DataFrame:
    """``df`` with ``out``, the canonical id of the source's id in ``column``: the bridge's, else a derived one."""
    known = bridge.where((F.col("entity_type") == entity) & (F.col("source") == source)).groupBy(F.col("source_id").alias("_sid")).agg(F.max("canonical_id").alias("_cid"))
    joined = df.join(known, F.col(column).cast("string") == F.col("_sid"), "left")
    return joined.withColumn(out, fx.id_or_hash("_cid", entity, source, column)).drop("_sid", "_cid")


def from_pitches(pitches: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row for each plate appearance of tracked ``pitches``; the state after it is the next one's first pitch.

    Pitches without an at-bat number are left out. Batter and pitcher are those of the last pitch. A blank event at
    the end of a half with two out, or one that says so, is TRUNCATED.
    """
    cols = ["pitch_number", "inning", "inning_topbot", "outs_when_up", "on_1b", "on_2b", "on_3b", "events", "batter_id", "pitcher_id", "raw_json", "dt"]
    pitches = pitches.where(F.col("at_bat_number").isNotNull())
    order = F.coalesce("pitch_number", F.lit(0))
    pitch = F.struct(*cols)
    pas = pitches.groupBy("game_pk", "at_bat_number").agg(F.min_by(pitch, order).alias("a"), F.max_by(pitch, order).alias("z"))
    pas = pas.withColumn("n", F.lead("a").over(Window.partitionBy("game_pk").orderBy("at_bat_number")))
    score = lambda side, name: F.get_json_object(F.col(f"{side}.raw_json"), f"$.{name}").try_cast("double").cast("long")
    bases = lambda side: fx.bases_from_ids(f"{side}.on_1b", f"{side}.on_2b", f"{side}.on_3b")
    last, same_half = F.col("n").isNull(), F.col("n").isNotNull() & F.col("n.inning").eqNullSafe(F.col("a.inning")) & F.col("n.inning_topbot").eqNullSafe(F.col("a.inning_topbot"))
    two_out = F.col("a.outs_when_up").eqNullSafe(F.lit(2))
    code = fx.event_code("z.events")
    blank = F.trim(F.coalesce("z.events", F.lit(""))) == ""
    pas = pas.withColumn("event_type", F.when((code == "UNKNOWN") & blank & ~same_half & two_out, "TRUNCATED").otherwise(code))
    cut_short = last & (F.col("event_type") == "TRUNCATED") & two_out
    ended = F.least(F.lit(3), F.coalesce("a.outs_when_up", F.lit(0)) + fx.final_outs("z.events", "event_type")).cast("long")
    pas = pas.withColumn("outs_after", F.when(cut_short, F.lit(3)).when(last, ended).when(same_half, F.col("n.outs_when_up")).otherwise(F.lit(3)).cast("long"))
    pas = pas.withColumn("base_state_after", F.when(cut_short, F.lit(0)).when(last, F.when(F.col("outs_after") == 3, F.lit(0))).when(same_half, bases("n")).otherwise(F.lit(0)).cast("long"))
    after = F.coalesce(F.when(same_half, score("n", "bat_score")), score("z", "post_bat_score"))
    pas = pas.select("*", F.col("z.batter_id").alias("_batter"), F.col("z.pitcher_id").alias("_pitcher"))
    pas = with_entity(with_entity(pas, bridge, "player", "mlb_statsapi", "_batter", "batter_id"), bridge, "player", "mlb_statsapi", "_pitcher", "pitcher_id")
    text = F.lit(None).cast("string")
    return pas.select(
        fx.canonical_id(F.concat(F.lit("pa:mlb_statcast:"), F.col("game_pk").cast("string"), F.lit(":"), F.col("at_bat_number").cast("string"))).alias("pa_id"),
        fx.canonical_id(F.concat(F.lit("game:mlb_statsapi:"), F.col("game_pk").cast("string"))).alias("game_id"),
        F.col("a.inning").cast("long").alias("inning"),
        F.coalesce(F.col("a.inning_topbot") == "Top", F.lit(False)).alias("is_top_inning"),
        text.alias("batting_team_id"),
        text.alias("fielding_team_id"),
        "batter_id",
        "pitcher_id",
        "event_type",
        F.lit(None).cast("long").alias("rbi"),
        (after - score("a", "bat_score")).alias("runs_scored_on_play"),
        (F.col("outs_after") - F.col("a.outs_when_up")).cast("long").alias("outs_on_play"),
        bases("a").alias("base_state_before"),
        F.col("a.outs_when_up").cast("long").alias("outs_before"),
        "base_state_after",
        "outs_after",
        F.col("a.dt").alias("dt"),
        F.lit("mlb_statcast").alias("source"),
        F.col("at_bat_number").cast("long").alias("play_order"),
    )


def from_text(events: DataFrame, bridge: DataFrame) -> DataFrame:
    """One row for each plate appearance of play-by-play ``events``, whose text tells outs, runners, results and scores.

    A header (kind 6) opens a plate appearance, a result (1) of the same inning, half and number ends it, the last
    result counting; pitches (0) are skipped. Only the last header of a half may lack a result: it is TRUNCATED.
    """
    game = ["game_id"]
    kind, text = F.coalesce(F.get_json_object("raw_event_json", "$.TextInfo_Bat_Text_Sec"), F.lit("")), F.coalesce("text_info_text", F.lit(""))
    mark = r"^\s*(?:試合開始\s*)?\d+回[表裏]\s*(\S)\s*\d+-\d+\s*(\S)"
    # all that follows runs on rows sorted once by game and order, so these are kept narrow: what only headers tell stays
    # with them, and a pitch has no text unless it names the teams
    of_header = lambda c: F.when(kind == "6", F.col(c)).alias(c)
    e = events.select("game_id", "inning", F.col("top_bottom").cast("string").alias("_half"), "play_ab", "play_seq_no", F.coalesce(fx.to_long("event_id"), F.lit(0)).alias("_at"), kind.alias("_kind"), F.when((kind != "0") | text.rlike(mark), text).otherwise("").alias("_text"), of_header("play_player_id"), of_header("dt"))
    order = ["_at", "play_seq_no", "_kind"]
    by_game = Window.partitionBy(*game).orderBy(*order)
    w = by_game.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = F.col("_text").rlike(mark)
    home = F.first(F.when(marked, F.regexp_extract("_text", mark, 1)), ignorenulls=True).over(w)
    away = F.first(F.when(marked, F.regexp_extract("_text", mark, 2)), ignorenulls=True).over(w)
    e = e.withColumns({"_home": home, "_away": away})
    pattern = F.concat(F.lit(r"\Q"), F.col("_home"), F.lit(r"\E\s*(\d+)-(\d+)\s*\Q"), F.col("_away"), F.lit(r"\E"))
    told = lambda i: F.nullif(F.call_function("regexp_extract", F.col("_text"), pattern, F.lit(i)), F.lit("")).try_cast("long")
    e = e.withColumns({"_h": F.when(F.col("_kind") != "0", told(1)), "_a": F.when(F.col("_kind") != "0", told(2))})
    new = F.when(F.col("_h").isNotNull() & F.col("_a").isNotNull(), F.struct(F.col("_h").alias("h"), F.col("_a").alias("a")))
    nil = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("a"))
    e = e.withColumns({"_s1": F.coalesce(filled_forward(new, game, order), nil), "_s0": F.coalesce(filled_forward(new, game, order, inclusive=False), nil)})
    e = segments(e, F.col("_kind") == "6", game, order, "_n").where("_n > 0")
    row = F.struct("inning", "_half", "play_ab", "_text", "_s0", "play_player_id", "dt", "_at")
    e = e.withColumn("p", filled_forward(F.when(F.col("_kind") == "6", row), game, order))
    half = F.struct(F.col("p.inning").alias("i"), F.col("p._half").alias("h"))
    same_half = F.col("inning").eqNullSafe(F.col("p.inning")) & F.col("_half").eqNullSafe(F.col("p._half"))
    same = same_half & F.col("play_ab").eqNullSafe(F.col("p.play_ab"))
    seen = fx.outs_in_text("_text")
    # the last of each so far, with its plate appearance: what the last row of a plate appearance has of its own
    last = lambda value, when: filled_forward(F.when(when, F.struct(F.col("_n").alias("n"), value.alias("v"))), game, order)
    e = e.withColumns({"_score": last(F.col("_s1"), same_half), "_result": last(F.col("_text"), (F.col("_kind") == "1") & same), "_seen": last(seen, ~F.col("_kind").isin("0", "6") & same_half & seen.isNotNull()), "_later": F.lead("_n").over(by_game)})
    own = lambda c: F.when(F.col(f"{c}.n") == F.col("_n"), F.col(f"{c}.v"))
    result = F.when(F.col("_result.n") == F.col("_n"), F.struct(F.col("_result.v").alias("t"))).alias("result")
    pas = e.where(F.col("_later").isNull() | (F.col("_later") > F.col("_n"))).select("game_id", *order, "_n", "p", own("_score").alias("score_after"), result, own("_seen").alias("outs_seen"))
    pas = pas.withColumn("_next", F.lead(half).over(by_game)).where(F.col("result").isNotNull() | F.col("_next").isNull() | ~F.col("_next").eqNullSafe(half))
    pas = pas.withColumn("n", F.lead(F.struct(half.alias("half"), F.col("p._text").alias("text"))).over(by_game))
    cast = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    continues = F.col("n").isNotNull() & F.col("n.half").eqNullSafe(half)
    before = fx.header_outs("p._text")
    truncated = F.col("result").isNull()
    outs = F.when(continues, fx.header_outs("n.text")).when(truncated, F.coalesce("outs_seen", F.when(F.col("n").isNotNull(), F.lit(3)).otherwise(before))).otherwise(F.coalesce(fx.outs_in_text("result.t"), F.lit(3)))
    pas = pas.withColumns({"outs_before": before, "outs_after": outs.cast("long")})
    bases = F.when(continues, fx.header_bases("n.text")).when(F.col("outs_after") == 3, F.lit(0)).when(~truncated, fx.bases_in_text("result.t"))
    top = F.when(F.col("p._half") == "1", True).when(F.col("p._half") == "2", False)
    after = F.coalesce("score_after", "p._s0")
    runs = F.when(top, after["a"] - F.col("p._s0.a")).when(~top, after["h"] - F.col("p._s0.h"))
    pas = pas.select(
        "game_id", "_n", F.col("p.inning").alias("inning"), F.col("p._half").alias("_half"), F.col("p.play_ab").alias("play_ab"), F.col("p.play_player_id").alias("_player"), F.col("p.dt").alias("dt"), top.alias("is_top_inning"), F.when(truncated, "TRUNCATED").otherwise(fx.result_code("result.t")).alias("event_type"),
        runs.alias("runs_scored_on_play"), fx.header_bases("p._text").alias("base_state_before"), "outs_before", bases.cast("long").alias("base_state_after"), "outs_after",
    )
    key = F.concat_ws(":", F.lit("pa:npb"), *[cast(F.col(c)) for c in ("game_id", "inning", "_half", "play_ab")])
    pas = ordinal_suffix(pas, key, ["game_id", "inning", "_half", "play_ab"], ["_n"], "_key")
    pas = with_entity(pas, bridge, "player", "npb_spaia", "_player", "batter_id")
    text = F.lit(None).cast("string")
    return pas.select(
        fx.canonical_id("_key").alias("pa_id"),
        fx.canonical_id(F.concat(F.lit("game:npb_spaia:"), F.col("game_id").cast("string"))).alias("game_id"),
        fx.to_long_truncated("inning").alias("inning"),
        "is_top_inning",
        text.alias("batting_team_id"),
        text.alias("fielding_team_id"),
        "batter_id",
        text.alias("pitcher_id"),
        "event_type",
        F.lit(None).cast("long").alias("rbi"),
        "runs_scored_on_play",
        (F.col("outs_after") - F.col("outs_before")).alias("outs_on_play"),
        "base_state_before",
        "outs_before",
        "base_state_after",
        "outs_after",
        "dt",
        F.lit("npb_spaia").alias("source"),
        F.col("_n").cast("long").alias("play_order"),
    )


def from_play_file(plays: DataFrame, bridge: DataFrame) -> DataFrame:
    """Plate appearances of a play file, one a row: a projection, ordered by the event number (0 if it isn't one)."""
    source = "retrosheet_local"
    p = plays
    for entity, column in (("player", "batter_id"), ("player", "pitcher_id"), ("team", "batting_team_id"), ("team", "pitching_team_id")):
        p = with_entity(p, bridge, entity, source, column, "_" + column)
    have = lambda c, kind: F.col(c).cast(kind) if c in plays.columns else F.lit(None).cast(kind)
    bases = lambda when: fx.bases_from_ids(*[f"br{i}_{when}" for i in (1, 2, 3)], absent=("", "0", "NA"))
    return p.select(
        fx.canonical_id(F.concat_ws(":", F.lit("pa:retrosheet"), have("game_id", "string"), have("event_id", "string"))).alias("pa_id"),
        fx.canonical_id(F.concat(F.lit("game:retrosheet_local:"), F.col("game_id").cast("string"))).alias("game_id"),
        have("inning", "long").alias("inning"),
        F.coalesce(F.col("top_bottom").cast("string").isin("0", "Top", "top"), F.lit(False)).alias("is_top_inning"),
        F.col("_batting_team_id").alias("batting_team_id"),
        F.col("_pitching_team_id").alias("fielding_team_id"),
        F.col("_batter_id").alias("batter_id"),
        F.col("_pitcher_id").alias("pitcher_id"),
        fx.flag_code(plays.columns).alias("event_type"),
        have("rbi", "long").alias("rbi"),
        have("runs", "long").alias("runs_scored_on_play"),
        (have("outs_post", "long") - have("outs_pre", "long")).alias("outs_on_play"),
        bases("pre").alias("base_state_before"),
        have("outs_pre", "long").alias("outs_before"),
        bases("post").alias("base_state_after"),
        have("outs_post", "long").alias("outs_after"),
        F.col("dt"),
        F.lit(source).alias("source"),
        F.coalesce(fx.to_long("event_id"), F.lit(0)).alias("play_order"),
    )


def with_teams(pas: DataFrame, games: DataFrame) -> DataFrame:
    """Fills batting and fielding teams from the games (game_id, home_team_id, away_team_id): away bats in the top half."""
    sides = games.groupBy("game_id").agg(F.max_by("home_team_id", "dt").alias("_home"), F.max_by("away_team_id", "dt").alias("_away"))
    joined = pas.join(sides, "game_id", "left")
    pick = lambda top, bottom: F.when(F.col("is_top_inning"), F.col(top)).when(~F.col("is_top_inning"), F.col(bottom))
    filled = joined.withColumns({"batting_team_id": F.coalesce("batting_team_id", pick("_away", "_home")), "fielding_team_id": F.coalesce("fielding_team_id", pick("_home", "_away"))})
    return filled.drop("_home", "_away")


def with_runs_to_end(pas: DataFrame) -> DataFrame:
    """runs_to_end_of_inning: runs from each plate appearance to the end of its half, known only where it has three outs."""
    half = ["source", "game_id", "inning", "is_top_inning"]
    filled = suffix_sum(pas, "runs_scored_on_play", half, ["play_order"], "runs_to_end_of_inning", complete=F.col("outs_after") == 3)
    known: Column = F.col("inning").isNotNull() & F.col("is_top_inning").isNotNull()
    return filled.withColumn("runs_to_end_of_inning", F.when(known, F.col("runs_to_end_of_inning")))
