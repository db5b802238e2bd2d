"""Every query of the engine against the same in DuckDB, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from infield import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5)
    return str(value)[:19] if hasattr(value, "isoformat") else value


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_duckdb(spark, duck, name):
    df = queries.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    result = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert ours == sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall()), key=repr)


def test_all_queries_have_rows_or_a_reason(spark):
    empty = {"J12_orphans", "A14_duplicates", "U03_day_difference"}
    for name in set(queries.queries()) - set(queries.oracle_sql()) - empty:
        assert queries.queries()[name](spark, str(DATA)).count() > 0
