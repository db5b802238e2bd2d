"""Breakout data set and model: daily lines, windows, labels without leakage, logistic regression, evaluation."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from infield.functions import columns as fx
from infield.operators.relational import tied_rank_auc, top_k

STATS = ["pa", "ab", "h", "doubles", "triples", "hr", "bb", "hbp", "so", "sf", "sh", "woba_den", "woba_value"]


@dataclass(frozen=True)
class Breakout:
    """Windows in days, thresholds, and the weights of weighted on-base average."""

    sources: tuple[str, ...] = ("mlb_statcast", "npb_spaia")
    baseline_days: int = 30
    recent_days: int = 7
    label_days: int = 14
    min_baseline_pa: int = 50
    min_label_pa: int = 30
    margin_woba: float = 0.05
    woba_weights: Mapping[str, float] = field(default_factory=lambda: {"BB": 0.69, "HBP": 0.72, "1B": 0.88, "2B": 1.25, "3B": 1.58, "HR": 2.03})

    def __post_init__(self):
        if not 0 < self.label_days < self.baseline_days or not 0 < self.recent_days <= self.baseline_days:
            raise ValueError("windows must be positive, recent within and label shorter than the baseline")
        if any(w <= 0 for w in self.woba_weights.values()):
            raise ValueError("weights must be positive")

    @property
    def version(self) -> str:
        return hashlib.sha1(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()[:8]


@dataclass(frozen=True)
class Splits:
    train_end: str
    validation_end: str
    embargo_days: int

    def __post_init__(self):
        if self.train_end >= self.validation_end:
            raise ValueError("train must end before validation")


def batter_daily(pas: DataFrame, cfg: Breakout) -> DataFrame:
    """Each batter's counting line of each day and league. Truncated rows are no plate appearances."""
    league = fx.league_of("source")
    e = F.col("event_type")
    flag = lambda *codes: F.sum(e.isin(*codes).cast("int"))
    weight = F.coalesce(fx.first_match([(e == k, v) for k, v in cfg.woba_weights.items()], None).cast("double"), F.lit(0.0))
    rows = pas.where(F.col("source").isin(*cfg.sources) & fx.present("batter_id") & ~F.coalesce(e == "TRUNCATED", F.lit(False)))
    return rows.groupBy("dt", F.col("batter_id").alias("player_id"), league.alias("league_code")).agg(
        F.count("*").alias("pa"), flag(*fx.AT_BATS).alias("ab"), flag(*fx.HITS).alias("h"), flag("2B").alias("doubles"), flag("3B").alias("triples"), flag("HR").alias("hr"), flag("BB").alias("bb"), flag("HBP").alias("hbp"),
        flag("K").alias("so"), flag("SF").alias("sf"), flag("SH").alias("sh"), flag(*fx.AT_BATS, "BB", "HBP", "SF").alias("woba_den"), F.round(F.sum(weight), 6).alias("woba_value"), F.min("source").alias("source"),
    )


def windows_of(as_of: str, cfg: Breakout) -> dict[str, tuple[str, str]]:
    """Inclusive day ranges of the features (ending with ``as_of``) and of the label (beginning after it)."""
    day = date.fromisoformat(as_of)
    back = lambda n: (day - timedelta(days=n - 1)).isoformat()
    return {"base": (back(cfg.baseline_days), as_of), "recent": (back(cfg.recent_days), as_of), "day": (as_of, as_of), "label": ((day + timedelta(days=1)).isoformat(), (day + timedelta(days=cfg.label_days)).isoformat())}


def _rate(a: Column, b: Column) -> Column:
    return fx.rounded(fx.ratio(a, b), 6)


def split_of(day: Column, s: Splits) -> Column:
    """train, validation or test by date, for rows that don't look ahead."""
    return F.when(day <= s.train_end, "train").when(day <= s.validation_end, "validation").otherwise("test")


def embargoed_split_of(day: Column, s: Splits) -> Column:
    """The same with the days before a cut, whose labels cross it, in no split."""
    cut = lambda end: F.date_sub(F.to_date(F.lit(end)), s.embargo_days).cast("string")
    return F.when(day <= cut(s.train_end), "train").when(day <= s.train_end, "embargo").when(day <= cut(s.validation_end), "validation").when(day <= s.validation_end, "embargo").otherwise("test")


def examples(daily: DataFrame, published: DataFrame, as_of: str, cfg: Breakout, splits: Splits) -> DataFrame:
    """Feature and label rows of the batters with enough plate appearances in the baseline window of ``as_of``."""
    day = published.sparkSession.createDataFrame([(as_of,)], "dt string")
    return _examples(daily, published, day, as_of, as_of, cfg, splits)


def example_range(daily: DataFrame, published: DataFrame, first: str, last: str, cfg: Breakout, splits: Splits) -> DataFrame:
    """The rows of examples() for every published day from ``first`` to ``last``, in one pass over the daily lines.

    ``daily`` is batter_daily(), a row for each day, player and league; ``published`` has a row for each published dt: a
    label stays pending until every day of its window is there.
    """
    days = published.where(F.col("dt").between(first, last)).select("dt").distinct()
    return _examples(daily, published, days, first, last, cfg, splits)


def window_sums(daily: DataFrame, days: DataFrame, first: str, last: str, keys: Sequence[str], measures: Sequence[str], windows: Mapping[str, tuple[int, int]]) -> DataFrame:
    """For every day of ``days`` (dt) and each key, sums of every measure over every window of days around it.

    A window is (from, to) in days from the day, both included. Each key has a dense grid of days with prefix sums, and a
    window is the difference of two of them, so any number of windows costs one pass: the lines and the empty days of the
    grid are dealt by key once, and grouping and prefix sums stay where they are. Sums are exact decimals, so that a
    difference loses nothing. Days on which all windows of a key are empty have no row.
    """
    low, high = min(a for a, _ in windows.values()), max(b for _, b in windows.values())
    shifted = lambda day, n: F.date_add(F.to_date(F.lit(day)), n)
    kinds = dict(daily.dtypes)
    exact = {m: F.col(m).cast("decimal(38,6)") if kinds[m] in ("double", "float") else F.col(m).cast("long") for m in measures}
    lines = daily.select(*keys, F.to_date("dt").alias("_day"), *[c.alias(m) for m, c in exact.items()]).where(F.col("_day").between(shifted(first, low), shifted(last, high)))
    # the grid reaches as far as a window of any day may look; a key's first and last lines bound it
    spans = lines.groupBy(*keys).agg(F.min("_day").alias("_a"), F.max("_day").alias("_b"))
    begin = F.date_sub("_a", max(high, 0) + 1)  # one empty day before what the first window needs
    end = F.greatest(F.date_add("_b", max(-low, 0)), F.col("_b"))
    grid = spans.select(*keys, F.explode(F.sequence(begin, end)).alias("_day"), *[F.lit(0).cast(lines.schema[m].dataType).alias(m) for m in measures])
    filled = lines.unionByName(grid).repartition(*keys).groupBy(*keys, "_day").agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
    ordered = Window.partitionBy(*keys).orderBy("_day")
    so_far = filled.select(*keys, "_day", *[F.sum(m).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"_upto_{m}") for m in measures], *[F.sum(m).over(Window.partitionBy(*keys)).alias(f"_all_{m}") for m in measures])

    def upto(measure: str, shift: int) -> Column:
        """The prefix sum ``shift`` days on: 0 before the grid, everything after it."""
        c = F.col(f"_upto_{measure}")
        if shift == 0:
            return c
        return F.coalesce(F.lag(c, -shift).over(ordered), F.lit(0)) if shift < 0 else F.coalesce(F.lead(c, shift).over(ordered), F.col(f"_all_{measure}"))

    sums = {f"{w}_{m}": (upto(m, b) - upto(m, a - 1)).cast("double" if kinds[m] in ("double", "float") else "long") for w, (a, b) in windows.items() for m in measures}
    wanted = days.select(F.to_date("dt").alias("_day")).distinct()
    every = so_far.select(*keys, "_day", *[v.alias(k) for k, v in sums.items()])
    return every.join(F.broadcast(wanted), "_day").withColumn("dt", F.col("_day").cast("string")).drop("_day")  # a row a day


def _examples(daily: DataFrame, published: DataFrame, days: DataFrame, first: str, last: str, cfg: Breakout, splits: Splits) -> DataFrame:
    windows = {"base": (1 - cfg.baseline_days, 0), "recent": (1 - cfg.recent_days, 0), "day": (0, 0), "label": (1, cfg.label_days)}
    lines = daily.withColumn("days", (F.col("pa") > 0).cast("int"))
    sums = window_sums(lines, days, first, last, ["player_id", "league_code"], [*STATS, "days"], windows)
    c = lambda window, stat: F.col(f"{window}_{stat}")
    sums = sums.where((c("base", "pa") > 0) | (c("label", "pa") > 0))
    league = Window.partitionBy("dt", "league_code")
    sums = sums.withColumn("f_league_base_woba", _rate(F.sum("base_woba_value").over(league), F.sum("base_woba_den").over(league)))
    balls = c("base", "ab") - c("base", "so") - c("base", "hr") + c("base", "sf")
    rows = sums.where(c("base", "pa") >= cfg.min_baseline_pa).select(
        "player_id", "league_code", F.substring("dt", 1, 4).cast("int").alias("season_year"), c("base", "pa").alias("f_base_pa"), _rate(c("base", "woba_value"), c("base", "woba_den")).alias("f_base_woba"), _rate(c("base", "so"), c("base", "pa")).alias("f_base_k_rate"),
        _rate(c("base", "bb"), c("base", "pa")).alias("f_base_bb_rate"), _rate(c("base", "doubles") + 2 * c("base", "triples") + 3 * c("base", "hr"), c("base", "ab")).alias("f_base_iso"), F.when(balls > 0, _rate(c("base", "h") - c("base", "hr"), balls)).alias("f_base_babip"), c("base", "days").alias("f_base_days"),
        c("recent", "pa").alias("f_recent_pa"), _rate(c("recent", "woba_value"), c("recent", "woba_den")).alias("f_recent_woba"), "f_league_base_woba", c("day", "pa").alias("f_day_pa"), c("day", "ab").alias("f_day_ab"), c("day", "h").alias("f_day_h"), c("day", "hr").alias("f_day_hr"),
        c("label", "pa").alias("_pa"), _rate(c("label", "woba_value"), c("label", "woba_den")).alias("_woba"), "dt",
    )
    # a published day completes the labels of the days before it
    before = F.explode(F.transform(F.sequence(F.lit(1), F.lit(cfg.label_days)), lambda n: F.date_sub(F.to_date("dt"), n).cast("string")))
    complete = published.select("dt").distinct().select(before.alias("dt")).groupBy("dt").agg((F.count("*") == cfg.label_days).alias("_done"))
    rows = rows.join(F.broadcast(complete.where("_done")), "dt", "left")  # a row a day
    done, delta = F.coalesce("_done", F.lit(False)), fx.rounded(F.col("_woba") - F.col("f_base_woba"), 6)
    labelled = done & (F.col("_pa") >= cfg.min_label_pa) & delta.isNotNull()
    return rows.withColumns({
        "f_base_woba_vs_league": fx.rounded(F.col("f_base_woba") - F.col("f_league_base_woba"), 6), "baseline_days": F.lit(cfg.baseline_days), "recent_days": F.lit(cfg.recent_days), "label_days": F.lit(cfg.label_days), "label_window_end": F.date_add(F.to_date("dt"), cfg.label_days).cast("string"),
        "label_status": F.when(~done, "pending").when(labelled, "labeled").otherwise("insufficient_pa"), "label_pa": F.when(done, F.col("_pa")), "label_woba": F.when(done, F.col("_woba")), "label_woba_delta": F.when(done, delta), "label_breakout": F.when(labelled, delta >= cfg.margin_woba - 1e-9),
        "split": embargoed_split_of(F.col("dt"), splits), "definition_version": F.lit(cfg.version),
    }).drop("_pa", "_woba", "_done")


INPUTS = ["base_woba_vs_league", "recent_minus_base_woba", "base_k_rate", "base_bb_rate", "base_iso", "base_babip", "log_base_pa", "recent_pa_share", "is_npb"]


def model_inputs(rows: DataFrame) -> DataFrame:
    """``rows`` of examples() with the model's inputs; null where a row can't say."""
    share = fx.ratio("f_recent_pa", "f_base_pa") * F.col("baseline_days") / F.col("recent_days")
    values = [F.col("f_base_woba_vs_league"), F.col("f_recent_woba") - F.col("f_base_woba"), F.col("f_base_k_rate"), F.col("f_base_bb_rate"), F.col("f_base_iso"), F.col("f_base_babip"), F.when(F.col("f_base_pa") > 0, F.log("f_base_pa")), share, (F.col("league_code") == "NPB").cast("double")]
    return rows.withColumns({f"x_{n}": v.cast("double") for n, v in zip(INPUTS, values, strict=True)})


@dataclass
class Model:
    inputs: list[str]
    means: list[float]
    deviations: list[float]
    coefficients: list[float]
    intercept: float
    l2: float
    definition_version: str = ""

    def score(self, prefix: str = "x_") -> Column:
        """Probability, as one column expression; a missing input counts as the training mean."""
        return fx.sigmoid(self.linear(prefix))

    def linear(self, prefix: str = "x_") -> Column:
        total = F.lit(self.intercept)
        for name, m, s, b in zip(self.inputs, self.means, self.deviations, self.coefficients, strict=True):
            total = total + F.coalesce((F.col(prefix + name) - m) / s, F.lit(0.0)) * b
        return total

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)


def fit(rows: DataFrame, label: str, inputs: Sequence[str], l2: float, version: str = "", prefix: str = "x_", most: int = 50, tolerance: float = 1e-10) -> Model:
    """Logistic regression with a penalty on all but the intercept, by Newton's method."""
    return fit_grid(rows, label, inputs, [l2], version, prefix, most, tolerance)[0]


def fit_grid(rows: DataFrame, label: str, inputs: Sequence[str], grid: Sequence[float], version: str = "", prefix: str = "x_", most: int = 50, tolerance: float = 1e-10) -> list[Model]:
    """The models of all penalties of ``grid`` at once: a Newton step of all of them is one pass over the rows.

    A task adds up gradients and Hessians of its rows by matrix products and sends one row for each number; what reaches the
    driver is one table of penalties by (inputs + 1) by (inputs + 2), whatever the rows. Models that have converged leave the
    pass. A missing input counts as the mean; rows without a label don't count. The scaled inputs are kept, on disk where
    memory is short, while it runs.
    """
    k = len(inputs)
    known = rows.where(F.col(label).isNotNull())
    stats = known.agg(*[f(prefix + n).alias(f"{a}_{n}") for n in inputs for a, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    means = [stats[f"m_{n}"] or 0.0 for n in inputs]
    deviations = [s if (s := stats[f"s_{n}"]) and s * s > 1e-12 else 1.0 for n in inputs]
    z = [F.coalesce((F.col(prefix + n) - m) / s, F.lit(0.0)).cast("double") for n, m, s in zip(inputs, means, deviations, strict=True)]
    scaled = known.select(*[c.alias(f"z{i}") for i, c in enumerate(z)], F.col(label).cast("double").alias("y")).persist()
    beta, active = np.zeros((len(grid), k + 1)), list(range(len(grid)))
    try:
        for _ in range(most):
            sums = _newton_sums(scaled, beta[active], k)
            if sums is None:
                raise ValueError("no rows to train on")
            still = []
            for at, g in enumerate(active):
                penalty = np.diag([0.0] + [grid[g]] * k)
                gradient, hessian = sums[at, :, 0] - penalty @ beta[g], sums[at, :, 1:] + penalty
                step = np.linalg.solve(hessian + 1e-12 * np.eye(k + 1), gradient)
                beta[g] += step
                if np.abs(step).max() >= tolerance:
                    still.append(g)
            active = still
            if not active:
                break
    finally:
        scaled.unpersist()
    return [Model(list(inputs), [round(m, 8) for m in means], [round(s, 8) for s in deviations], [round(float(b), 8) for b in row[1:]], round(float(row[0]), 8), l2, version) for row, l2 in zip(beta, grid, strict=True)]


def _newton_sums(scaled: DataFrame, beta: np.ndarray, k: int) -> np.ndarray | None:
    """For each row of ``beta`` the gradient (column 0) and the Hessian of the log likelihood over all rows; None without rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((len(beta), k + 1, k + 2)), False
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows), *[c.to_numpy(zero_copy_only=False) for c in batch.columns[:k]]])
            y, seen = batch.column(k).to_numpy(zero_copy_only=False), seen or batch.num_rows > 0
            for g, b in enumerate(beta):
                p = 1 / (1 + np.exp(-np.clip(x @ b, -700, 700)))
                total[g, :, 0] += x.T @ (y - p)
                total[g, :, 1:] += (x * (p * (1 - p))[:, None]).T @ x
        if seen:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "part"])

    found = scaled.mapInArrow(run, "at long, part double").groupBy("at").agg(F.sum("part").alias("part")).collect()
    if not found:
        return None
    out = np.zeros(len(beta) * (k + 1) * (k + 2))
    for r in found:
        out[r["at"]] = r.part
    return out.reshape(len(beta), k + 1, k + 2)


def evaluate(scored: DataFrame, probability: str, label: str) -> DataFrame:
    """auc, log_loss (clipped at 1e-15), brier, rows and positives, as one row."""
    y, p = F.col(label).cast("double"), F.greatest(F.least(F.col(probability), F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = scored.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"), F.avg((F.col(probability) - y) ** 2).alias("brier"), F.count("*").alias("rows"))
    return tied_rank_auc(scored, probability, label).join(F.broadcast(loss))


def losses(rows: DataFrame, scores: Mapping[str, Column], label: str) -> DataFrame:
    """log_loss, brier, rows and auc of each named score, in one pass and one shuffle of distinct scores."""
    y = F.col(label).cast("double")
    each = rows.where(F.col(label).isNotNull()).select(y.alias("y"), F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("p")) for n, c in scores.items()])).alias("s")).select("y", "s.*")
    p = F.greatest(F.least(F.col("p"), F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = each.where("p is not null").groupBy("name").agg(F.avg(-(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p))).alias("log_loss"), F.avg((F.col("p") - F.col("y")) ** 2).alias("brier"), F.count("*").alias("rows"))
    return tied_rank_auc(each, "p", "y", ["name"]).join(loss, "name")


def heuristics(rows: DataFrame) -> dict[str, Column]:
    """Rankings without a model, which the model has to beat: last week's gain, distance below the league, home runs of the day."""
    return {"recent_minus_base_woba": F.col("f_recent_woba") - F.col("f_base_woba"), "base_woba_below_league": -F.col("f_base_woba_vs_league"), "home_runs_of_the_day": F.col("f_day_hr").cast("double")}


def heuristic_aucs(rows: DataFrame, label: str) -> DataFrame:
    """The area under the curve of each heuristic over labelled rows (name, auc, positives, negatives), all in one pass."""
    each = rows.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("y"), F.explode(F.array(*[F.struct(F.lit(n).alias("name"), c.cast("double").alias("score")) for n, c in heuristics(rows).items()])).alias("s")).select("y", "s.*")
    return tied_rank_auc(each, "score", "y", ["name"])


def choose(train: DataFrame, validation: DataFrame, label: str, inputs: Sequence[str], grid: Sequence[float], min_rows: int, min_positives: int, version: str = "") -> tuple[Model, list[tuple[float, float]]]:
    """The model whose penalty has the least log loss on validation; refuses to train on too little.

    All penalties are fitted together and judged together.
    """
    rows, positives = train.agg(F.count(label), F.sum(F.col(label).cast("int"))).first()
    if rows < min_rows or (positives or 0) < min_positives:
        raise ValueError(f"{rows} rows with {positives} positives are too few")
    models = fit_grid(train, label, inputs, grid, version)
    found = {r.name: r.log_loss for r in losses(validation, {str(i): m.score() for i, m in enumerate(models)}, label).collect()}
    tried = [(l2, found[str(i)]) for i, l2 in enumerate(grid)]
    best = min(range(len(grid)), key=lambda i: (tried[i][1], grid[i]))
    return models[best], tried


def candidates(rows: DataFrame, model: Model, cfg: Breakout, most: int = 25) -> DataFrame:
    """The best ``most`` of each day and league, by score to six places and player; only rows of the model's own definition."""
    if model.definition_version != cfg.version or model.inputs != INPUTS:
        raise ValueError("the model was trained on another definition")
    scored = model_inputs(rows.where(F.col("definition_version") == cfg.version)).withColumn("score", F.round(model.score(), 6))
    return top_k(scored, ["dt", "league_code"], [F.desc("score"), "player_id"], most).select("player_id", "league_code", "season_year", "score", "rank", F.col("f_day_hr").alias("hr"), F.col("f_day_h").alias("h"), F.col("f_day_ab").alias("ab"), "f_base_pa", "f_base_woba", "f_recent_woba", F.col("label_days").alias("horizon_days"), "dt")


def split_summary(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy("split").agg(F.count("*").alias("rows"), F.sum(F.col(label).cast("int")).cast("long").alias("positives"), F.count_distinct("player_id").alias("players"), F.count_distinct("dt").alias("days"), F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt"))


def non_overlapping(rows: DataFrame, first: str, label_days: int) -> DataFrame:
    return rows.where(F.date_diff(F.to_date("dt"), F.to_date(F.lit(first))) % label_days == 0)


def dates_to_refresh(changed: Sequence[str], published: Sequence[str], cfg: Breakout) -> list[str]:
    """Published days whose examples or scores depend on the changed ones: the days whose baseline or label reads them."""
    out = set()
    for c in map(date.fromisoformat, changed):
        out |= {p for p in published if c - timedelta(days=cfg.label_days) <= date.fromisoformat(p) <= c + timedelta(days=cfg.baseline_days - 1)}
    return sorted(out)
