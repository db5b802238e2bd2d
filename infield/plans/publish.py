"""Range publishing: which days of which tables follow from changed ones, and one overwrite a table that brings them up to date.

A table says what it reads and over which days: a window of days around its own, or its season so far. The closure of a
change is found on sets of days, which are few; the rows are made by one plan a table and written by one dynamic overwrite.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from infield.sources import lake

Days = Sequence[str]
#: Makes the rows of the days asked for; gets a reader of tables by name.
Build = Callable[[Callable[[str], DataFrame], Days], DataFrame]


@dataclass(frozen=True)
class Reads:
    """Day d of a table reads days d + first to d + last of ``source``, or with ``season`` all days of its year up to d."""

    source: str
    first: int = 0
    last: int = 0
    season: bool = False

    def __post_init__(self):
        if self.first > self.last:
            raise ValueError("a window ends after it begins")

    def dependents(self, changed: set[str], days: Sequence[str]) -> set[str]:
        """Those of ``days`` that read any of ``changed``."""
        if self.season:
            first: dict[str, str] = {}
            for c in changed:
                first[c[:4]] = min(c, first.get(c[:4], c))
            return {d for d in days if d[:4] in first and d >= first[d[:4]]}
        reached = {(date.fromisoformat(c) - timedelta(days=n)).isoformat() for c in changed for n in range(self.first, self.last + 1)}
        return reached & set(days)


@dataclass(frozen=True)
class Table:
    name: str
    reads: Sequence[Reads]
    build: Build | None = None  #: None for a table that is written elsewhere


def ordered(tables: Sequence[Table]) -> list[Table]:
    """The tables, each after those it reads; an error for a circle. Sources without an entry are written elsewhere."""
    by_name = {t.name: t for t in tables}
    if len(by_name) < len(tables):
        raise ValueError("a table is there twice")
    try:
        names = TopologicalSorter({t.name: [r.source for r in t.reads] for t in tables}).static_order()
        return [by_name[n] for n in names if n in by_name]
    except CycleError as e:
        raise ValueError(f"tables that read each other: {' -> '.join(e.args[1])}") from e


def affected(tables: Sequence[Table], changed: Mapping[str, Sequence[str]], days: Sequence[str]) -> dict[str, list[str]]:
    """Days by table that a change calls for: the changed ones, and those of ``days`` (published ones) that depend on them.

    A table's days that follow change what reads it in turn. Tables without a day are left out.
    """
    touched = {name: set(d) for name, d in changed.items()}
    for t in ordered(tables):
        own = touched.setdefault(t.name, set())
        for r in t.reads:
            own |= r.dependents(touched.get(r.source, set()), days)
    return {name: sorted(d) for name, d in touched.items() if d}


def affected_rows(changed: DataFrame, published: DataFrame, tables: Sequence[Table]) -> DataFrame:
    """The closure as rows (table_name, dt), from rows of changed days (table_name, dt) and of published ones (dt)."""
    spark = changed.sparkSession
    days = [r.dt for r in published.select("dt").distinct().orderBy("dt").collect()]  # a row a day
    told: dict[str, list[str]] = {}
    for r in changed.select("table_name", "dt").distinct().collect():
        told.setdefault(r.table_name, []).append(r.dt)
    found = affected(tables, told, days)
    return spark.createDataFrame([(t, d) for t, own in sorted(found.items()) for d in own], "table_name string, dt string")


def publish(spark: SparkSession, root: str, tables: Sequence[Table], changed: Mapping[str, Sequence[str]], days: Sequence[str]) -> dict[str, list[str]]:
    """Brings every table that follows from ``changed`` up to date, in order, and gives the days written by table.

    ``days`` are the published ones, in any order, with the changed ones among them. A table reads those before it as they
    are after their own write. Days that end up without rows are emptied. A failure leaves the tables before it written and
    the rest as they were; the same call again does the rest, as it writes the same days.
    """

    def read(name: str) -> DataFrame:
        df = lake.read(spark, root, name)
        if df is None:
            raise ValueError(f"{name} isn't there")
        return df

    found = affected(tables, changed, days)
    written = {}
    for t in ordered(tables):
        own = found.get(t.name)
        if own and t.build is not None:
            lake.write_days(t.build(read, own).where(F.col("dt").isin(own)), root, t.name, own)
            written[t.name] = own
    return written


def derived_tables(baseline_days: int, label_days: int, builds: Mapping[str, Build]) -> list[Table]:
    """The tables that follow from plate appearances: run expectancy by day and season so far, batters' days, examples, scores.

    Examples read the baseline before a day and the label window after it, so a late day rewrites examples up to
    ``label_days`` before it, whose labels it completes, and ``baseline_days`` - 1 after it.
    """
    pas, window = "fact_plate_appearance", Reads("feature_batter_daily", 1 - baseline_days, label_days)
    return [
        Table("run_expectancy_daily", [Reads(pas)], builds.get("run_expectancy_daily")),
        Table("run_expectancy", [Reads("run_expectancy_daily", season=True)], builds.get("run_expectancy")),
        Table("feature_batter_daily", [Reads(pas)], builds.get("feature_batter_daily")),
        Table("ml_breakout", [window, Reads("ml_split", 0, label_days)], builds.get("ml_breakout")),
        Table("ml_breakout_score", [Reads("ml_breakout")], builds.get("ml_breakout_score")),
    ]
