"""Where queries register themselves, and how they read the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries are called {f.__name__}")
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))


EV = "WITH ev AS (SELECT *, strftime(ts, '%Y-%m-%d') AS dt FROM events)"


def id_sql(key: str) -> str:
    """The canonical id in SQL: five bits at a time of the hash's hexadecimal digits."""
    digit = lambda i: f"(strpos('0123456789abcdef', substr(h, {i + 1}, 1)) - 1)"
    parts = []
    for k in range(26):
        bit = 5 * k
        at, shift = bit // 4, 3 - bit % 4
        parts.append(f"substr('0123456789ABCDEFGHJKMNPQRSTVWXYZ', CAST((({digit(at)} * 16 + {digit(at + 1)}) >> {shift}) & 31 AS INTEGER) + 1, 1)")
    return f"(SELECT {' || '.join(parts)} FROM (SELECT sha256({key} || '|infield') AS h))"
