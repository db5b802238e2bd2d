"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn is written as ``<s>role[INST]text</s>``. Control strings inside roles and texts get a backslash after their
first character, and backslashes are doubled, which undoes exactly. Prefix sums of the turns' tokens cut a
conversation into spans of whole turns; each window repeats the system turn and the history just before its span,
and only the assistant texts of the span itself are under the loss mask, so each is a target once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "</s>"
#: Tokens of a span and of the history before it. A span holds the turns that start in its stretch of SPAN tokens, so
#: a window has at most the system turn, HISTORY, SPAN and what the last turn runs over; no turn is ever cut.
SPAN, HISTORY = 1_500, 1_000


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"<(?=/?s>)|\[(?=/?INST\])", r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def windows(turns: DataFrame, tokens: Column | None = None, span: int = SPAN, history: int = HISTORY) -> DataFrame:
    """One row for each window of the conversations ``turns`` (conv_id, turn, role, text).

    conv_id, window (from 0), formatted (the text), repeated (its leading turns that earlier windows have as theirs),
    n_turns (those that are new) and loss (array of start and length in code points: the escaped assistant texts of
    new turns). ``tokens`` counts a turn's tokens; by default its code points once formatted.

    Null roles and texts are empty; turns with the same number are in order of role and text, a null number comes
    first. Rows with a null conv_id are one conversation. Repeated rows are turns of their own. An empty table has no
    windows. A conversation is one row on the way: it must fit an executor's memory, as its window's text must.
    """
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), *([] if tokens is None else [tokens.cast("long").alias("tokens")]))
    turns = turns.withColumns({"head": F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MIDDLE)), "body": escaped(F.col("text"))})
    if tokens is None:
        turns = turns.withColumn("tokens", F.length("head") + F.length("body") + len(CLOSE))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = turns.withColumn("nth", F.row_number().over(order)).withColumn("before", F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = placed.withColumn("span", F.floor(F.col("before") / span))
    system = F.col("role") == "system"
    turn = F.struct("nth", "span", "before", (F.col("before") + F.col("tokens")).alias("after"), system.alias("system"), (F.col("role") == "assistant").alias("target"), "head", "body")
    # Spans are numbered anew, as a long turn may leave some empty.
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = whole.withColumn("spans", F.array_sort(F.array_distinct(F.transform("turns", lambda t: t["span"]))))
    whole = whole.withColumn("system", F.coalesce(F.array_min(F.transform(F.filter("turns", lambda t: t["system"]), lambda t: t["nth"])), F.lit(0)))
    each = whole.select("conv_id", "turns", "system", F.posexplode("spans").alias("window", "span"))
    own = each.withColumn("own", F.filter("turns", lambda t: t["span"] == F.col("span")))
    start, first = F.col("own")[0]["before"], F.col("own")[0]["nth"]
    old = F.filter("turns", lambda t: (t["nth"] < first) & ((t["nth"] == F.col("system")) | (t["before"] >= start - history)))
    own = own.withColumn("old", old).select("conv_id", "window", "old", "own")
    text = lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))
    join = lambda ts: F.concat_ws("", F.transform(ts, text))
    own = own.withColumn("before_own", F.length(join(F.col("old"))))
    empty = F.expr("cast(array() as array<struct<start:int,length:int>>)")
    spans = F.aggregate(
        "own",
        F.struct(F.col("before_own").alias("at"), empty.alias("loss")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["head"]) + F.length(t["body"]) + len(CLOSE)).alias("at"),
            F.when(t["target"], F.concat(s["loss"], F.array(F.struct((s["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length"))))).otherwise(s["loss"]).alias("loss"),
        ),
        lambda s: s["loss"],
    )
    return own.select("conv_id", "window", F.concat(join(F.col("old")), join(F.col("own"))).alias("formatted"), F.size("old").alias("repeated"), F.size("own").alias("n_turns"), spans.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of each conversation, from windows() alone."""
    parts = F.split("formatted", CLOSE, -1)
    new = F.slice(parts, F.col("repeated") + 1, F.size(parts) - 1 - F.col("repeated"))
    role = lambda p: unescaped(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), MIDDLE, 1))
    text = lambda p: unescaped(F.substr(p, F.instr(p, MIDDLE) + len(MIDDLE)))
    turns = F.concat_ws("", F.transform(new, lambda p: F.concat(role(p), F.lit("\n"), text(p), F.lit("\n"))))
    loss = F.concat_ws("", F.transform("loss", lambda x: unescaped(F.substr(F.col("formatted"), x["start"] + 1, x["length"]))))
    read = formatted.select("conv_id", "window", F.size(new).alias("n"), turns.alias("turns"), loss.alias("loss"), F.length("formatted").alias("chars"))
    rows = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    joined = lambda name: F.concat_ws("", F.transform("w", lambda x: x[name]))
    return rows.select(
        "conv_id",
        F.col("n_turns").cast("long"),
        F.sha2(joined("turns"), 256).alias("turns_sha256"),
        F.length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long"),
    )
