"""Operators that every layer uses: de-duplication, ordered state, windows, snapshots, SCD2, audits.

All take and return DataFrames. Windows are partitioned by the entity (game, player, key), never global.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Cols = Sequence[str | Column]
STRETCHES = 64  #: that ranks over a whole table are dealt to


def keep_first(df: DataFrame, keys: Cols, order: Cols) -> DataFrame:
    """The first row of each key in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, keys: Cols, order: Sequence[str]) -> DataFrame:
    return keep_first(df, keys, [F.desc_nulls_last(c) for c in order])


def top_k(df: DataFrame, keys: Cols, order: Cols, k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key, numbered."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def suffix_sum(df: DataFrame, value: str, groups: Cols, order: Cols, out: str, complete: Column | None = None) -> DataFrame:
    """Sum of ``value`` from each row to the end of its group; null from the last null on backwards.

    ``complete`` is looked at on the group's last row: where it isn't true, the whole group is null.
    """
    w = Window.partitionBy(*groups).orderBy(*order)
    rest = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    known = F.count_if(F.col(value).isNull()).over(rest) == 0
    if complete is not None:
        known &= F.coalesce(F.last(complete).over(rest), F.lit(False))
    return df.withColumn(out, F.when(known, F.sum(value).over(rest)))


def next_state(df: DataFrame, columns: Sequence[str], groups: Cols, order: Cols, prefix: str = "next_") -> DataFrame:
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumns({prefix + c: F.lead(c).over(w) for c in columns})


def segments(df: DataFrame, starts: Column, groups: Cols, order: Cols, out: str) -> DataFrame:
    """Numbers rows by how many starts came so far in the group, themselves included."""
    w = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.count_if(starts).over(w))


def filled_forward(value: Column, groups: Cols, order: Cols, inclusive: bool = True) -> Column:
    """The last value that isn't null so far; without ``inclusive``, before the row."""
    w = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return F.last(value, ignorenulls=True).over(w)


def ordinal_suffix(df: DataFrame, key: Column, groups: Cols, order: Cols, out: str) -> DataFrame:
    """``key`` for the first row of a group, ``key#2`` and so on for the next ones."""
    n = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn(out, F.concat(key, F.when(n == 1, "").otherwise(F.concat(F.lit("#"), n.cast("string")))))


def streaks(df: DataFrame, entity: Cols, order: Cols, hit: Column, day: str) -> DataFrame:
    """Runs of consecutive rows of an entity for which ``hit`` holds: start, end and length."""
    all_rows = F.row_number().over(Window.partitionBy(*entity).orderBy(*order))
    same = F.row_number().over(Window.partitionBy(*entity, "_hit").orderBy(*order))
    marked = df.withColumn("_hit", F.coalesce(hit, F.lit(False))).withColumn("_island", all_rows - same)
    return marked.where("_hit").groupBy(*entity, "_island").agg(F.min(day).alias("start_dt"), F.max(day).alias("end_dt"), F.count("*").alias("length")).drop("_island")


def interleave(df: DataFrame, side: str, score: str, tie: str, out: str = "position") -> DataFrame:
    """Numbers rows round robin over the sides: each side's best first, sides by their best score.

    For the rows of a report, a bounded top k that the caller has taken: their numbering is one global window.
    """
    within = Window.partitionBy(side).orderBy(F.desc(score), tie)
    placed = df.withColumn("_round", F.row_number().over(within)).withColumn("_best", F.first(score).over(within))
    return placed.withColumn(out, F.row_number().over(Window.orderBy("_round", F.desc("_best"), side))).drop("_round", "_best")


def latest_snapshot(df: DataFrame, by: str = "dt", groups: Sequence[str] = ()) -> DataFrame:
    """The rows of the newest ``by``, of each group if there are any, found with one aggregate instead of a window."""
    if not groups:
        return df.join(F.broadcast(df.agg(F.max(by).alias(by))), by, "left_semi")
    newest = df.groupBy(*[F.col(c).alias(f"_{i}") for i, c in enumerate(groups)]).agg(F.max(by).alias("_newest"))
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(groups)]
    return df.join(newest, reduce(lambda a, b: a & b, same, F.col(by) == F.col("_newest")), "left_semi")


def latest_fetch(df: DataFrame, groups: Cols, checksum: str, fetched: str) -> DataFrame:
    """In each group the rows of the newest fetch's checksum; all rows where none has one."""
    newest = df.where(F.col(checksum).isNotNull()).groupBy(*groups).agg(F.max_by(checksum, F.struct(fetched, checksum)).alias("_newest"))
    joined = df.join(newest, list(groups), "left")
    return joined.where(F.col("_newest").isNull() | (F.col(checksum) == F.col("_newest"))).drop("_newest")


def left_plus_anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows with what the right side knows of them, and right rows that the left side lacks."""
    return left.join(right, keys, "left").unionByName(right.join(left, keys, "left_anti"), allowMissingColumns=True)


def scd2(previous: DataFrame, today: DataFrame, key: str, tracked: Sequence[str], dt: str, previous_dt: str) -> DataFrame:
    """The snapshot of ``dt`` of a slowly changing dimension of type 2, from that of ``previous_dt`` and today's rows.

    Closed versions stay as they are. A key whose tracked attributes equal (nulls too) keeps its start and takes
    today's other columns; a changed one closes the day before dt and opens anew; a new one opens; one that is
    missing today is carried on. Rows of the previous snapshot without a key are dropped.
    """
    names = [c for c in today.columns if c not in ("valid_from_dt", "valid_to_dt", "is_current")]
    versions = [*names, "valid_from_dt", "valid_to_dt", "is_current"]
    for c in names:
        if c not in previous.columns:
            previous = previous.withColumn(c, F.lit(None).cast(today.schema[c].dataType))
    previous = previous.where(F.col(key).isNotNull() & (F.col(key) != "")).select(*versions)
    closed = previous.where(~F.coalesce("is_current", F.lit(True)))
    old = previous.where(F.coalesce("is_current", F.lit(True))).select(*[F.col(c).alias("old_" + c) for c in versions])
    new = today.select(*[F.col(c).alias("new_" + c) for c in names])
    both = old.join(new, F.col("old_" + key) == F.col("new_" + key), "full_outer")
    was, now = F.col("old_" + key).isNotNull(), F.col("new_" + key).isNotNull()
    same = reduce(lambda a, b: a & b, [F.col("old_" + c).eqNullSafe(F.col("new_" + c)) for c in tracked])
    row = lambda side, start, end, current: F.struct(*[F.col(f"{side}_{c}").alias(c) for c in names], start.cast("string").alias("valid_from_dt"), end.cast("string").alias("valid_to_dt"), current.alias("is_current"))
    carry = F.array(row("old", F.col("old_valid_from_dt"), F.col("old_valid_to_dt"), F.coalesce("old_is_current", F.lit(True))))
    opened = row("new", F.lit(dt), F.lit(None), F.lit(True))
    kept = row("new", F.coalesce(F.nullif(F.col("old_valid_from_dt"), F.lit("")), F.lit(previous_dt)), F.lit(None), F.lit(True))
    ended = row("old", F.col("old_valid_from_dt"), F.date_sub(F.to_date(F.lit(dt)), 1), F.lit(False))
    rows = F.when(~now, carry).when(~was, F.array(opened)).when(same, F.array(kept)).otherwise(F.array(ended, opened))
    return closed.unionByName(both.select(F.explode(rows).alias("r")).select("r.*"))


def multi_window_sums(df: DataFrame, keys: Cols, day: str, windows: dict[str, tuple[str, str]], measures: Sequence[str]) -> DataFrame:
    """Sums of every measure over every window of days (inclusive), in one pass: columns ``<window>_<measure>``."""
    days = F.col(day)
    sums = [F.sum(F.when(days.between(F.lit(a), F.lit(b)), F.col(m))).alias(f"{w}_{m}") for w, (a, b) in windows.items() for m in measures]
    lo, hi = min(a for a, _ in windows.values()), max(b for _, b in windows.values())
    return df.where(days.between(F.lit(lo), F.lit(hi))).groupBy(*keys).agg(*sums)


def rolling_sums(df: DataFrame, keys: Cols, day: str, measures: Sequence[str], as_of: str, days: int) -> DataFrame:
    """Sums over the ``days`` days that end with ``as_of``; rows with a null key are left out, nulls sum to 0."""
    wanted = df.where(F.to_date(day).between(F.date_sub(F.to_date(F.lit(as_of)), days - 1), F.to_date(F.lit(as_of))))
    for k in keys:
        wanted = wanted.where(F.col(k).isNotNull() if isinstance(k, str) else k.isNotNull())
    return wanted.groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])


def dense_running_sums(daily: DataFrame, days: DataFrame, keys: Sequence[str], day: str, season: str, measures: Sequence[str]) -> DataFrame:
    """For every day of ``days`` (day, season) the season's sums so far of each key seen so far in it.

    ``daily`` has one row for each day and key. The grid is days by keys, after aggregation, not days by rows.
    """
    first = daily.groupBy(season, *keys).agg(F.min(day).alias("_first"))
    grid = first.join(days, season).where(F.col(day) >= F.col("_first")).drop("_first")
    w = Window.partitionBy(season, *keys).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = grid.join(daily, [season, *keys, day], "left")
    return filled.withColumns({m: F.sum(F.coalesce(m, F.lit(0))).over(w) for m in measures})


def tied_rank_auc(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by average ranks: auc, positives and negatives of each group.

    The distinct scores are counted once, and kept until the areas are known. Those of a group are cut into STRETCHES
    stretches at about equal counts; a rank is that within the stretch, summed by window, plus the rows of the stretches
    before. So a window holds one stretch of one group, or the totals of a group's stretches, and never all scores.
    """
    key = F.struct(*[F.col(g) for g in groups], F.lit(0).alias("_one"))
    scores = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(key.alias("_key"), F.col(score).cast("double").alias("_score")).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    scores = scores.persist()
    cuts = scores.groupBy("_key").agg(F.percentile_approx("_score", [i / STRETCHES for i in range(1, STRETCHES)]).alias("_cuts"))
    same = F.col("s._key").eqNullSafe(F.col("c._key"))
    placed = scores.alias("s").join(cuts.alias("c"), same).select("s.*", F.size(F.filter("_cuts", lambda c: c < F.col("_score"))).alias("_stretch"))
    totals = placed.groupBy("_key", "_stretch").agg(F.sum("n").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_key", "_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    w = Window.partitionBy("_key", "_stretch").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.select("_key", "_stretch", "n", "pos", (F.coalesce(F.sum("n").over(w), F.lit(0)) + (F.col("n") + 1) / F.lit(2.0)).alias("_rank"))
    # ranks within a stretch, and what lies before it, add up by stretch
    parts = ranked.groupBy("_key", "_stretch").agg(F.sum(F.col("pos") * F.col("_rank")).alias("_inside"), F.sum("pos").alias("_pos"), F.sum(F.col("n") - F.col("pos")).alias("_neg"))
    parts = parts.alias("p").join(totals.alias("t"), F.col("p._key").eqNullSafe(F.col("t._key")) & (F.col("p._stretch") == F.col("t._stretch"))).select("p.*", "t._before")
    p, n = F.sum("_pos"), F.sum("_neg")
    area = (F.sum(F.col("_inside") + F.col("_pos") * F.col("_before")) - p * (p + 1) / F.lit(2.0)) / F.nullif(p.cast("double") * n, F.lit(0.0))
    found = parts.groupBy("_key").agg(area.alias("auc"), p.alias("positives"), n.alias("negatives")).select(*[F.col(f"_key.{g}").alias(g) for g in groups], "auc", "positives", "negatives")
    if not groups:  # one row, of nulls if there is nothing to rank
        found = found.agg(F.max("auc").alias("auc"), F.max("positives").alias("positives"), F.max("negatives").alias("negatives"))
    found = found.persist()
    found.count()  # a row a group, made now
    scores.unpersist()
    return found


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(keys), list(columns), name, value)


# Audits -------------------------------------------------------------------------------------------------

def duplicate_groups(df: DataFrame, keys: Cols) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def duplicate_kinds(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys repeat with identical rows, and how many with conflicting ones."""
    content = F.md5(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(content).alias("kinds")).where("n > 1")
    return groups.agg(F.count_if(F.col("kinds") == 1).alias("identical"), F.count_if(F.col("kinds") > 1).alias("conflicting"), F.coalesce(F.sum("n") - F.count("*"), F.lit(0)).alias("extra_rows"))


def null_rates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Share of rows without a value, by column, in one pass; '', '[]' and '{}' are none."""
    empty = lambda c: F.avg(F.when(F.col(c).isNull() | F.trim(F.col(c).cast("string")).isin("", "[]", "{}"), 1.0).otherwise(0.0)).alias(c)
    columns = list(columns)
    return df.agg(*[empty(c) for c in columns]).unpivot([], columns, "column", "null_rate")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows with a key that no parent has; null keys don't count."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")
