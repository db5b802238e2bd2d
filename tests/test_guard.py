"""Free SQL: what the parsed plan allows and what it doesn't."""

import pytest

from infield.plans.guard import RequestError, guarded, query

GOOD = [
    "SELECT * FROM t",
    "SELECT 'drop table; x' AS a ;",
    "SELECT `x`, 'it''s -- no; comment' AS b FROM `t` -- parquet.`x`",
    "WITH a AS (SELECT x FROM t), b AS (SELECT * FROM a) SELECT max(x) OVER (PARTITION BY x ORDER BY x ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS m, CASE WHEN x IN (SELECT x FROM b) THEN 1 END AS c, (SELECT 1) AS d FROM t WHERE EXISTS (SELECT 1 FROM u) AND x BETWEEN 1 AND 2 ORDER BY 1 LIMIT 3",
    "SELECT x, grouping(x), count(*) FROM t GROUP BY GROUPING SETS ((x), ()) HAVING count(*) > 0",
    "SELECT transform(z, v -> v + 1), date '2024-01-01', interval 1 day, cast(x AS int), extract(year FROM d), st.q, trim(BOTH ' ' FROM s), s LIKE 'a%', s RLIKE 'a', substring(s FROM 1 FOR 1), position('a' IN s), if(x > 1, 1, 2), -x, x % 2, x DIV 2, d + interval 1 day, current_date FROM t",
    "SELECT q.w FROM t LATERAL VIEW explode(z) q AS w",
    "SELECT x FROM t UNION ALL SELECT x FROM u EXCEPT SELECT x FROM u",
    "SELECT * FROM (SELECT x, s FROM t) PIVOT (sum(x) FOR s IN ('a', 'b'))",
    "SELECT * FROM t UNPIVOT (v FOR k IN (x, y))",
    "SELECT * FROM (SELECT x, y FROM t) JOIN range(3) r ON r.id = x",
    "SELECT t.x, v.y FROM t JOIN LATERAL (SELECT t.x + 1 AS y) v",
    "SELECT first(x IGNORE NULLS), percentile_cont(0.5) WITHIN GROUP (ORDER BY x), count(DISTINCT x) FILTER (WHERE y > 1) FROM t",
    "SELECT sum(x) OVER w FROM t WINDOW w AS (ORDER BY x)",
    "FROM t SELECT DISTINCT x LIMIT 2 OFFSET 1",
]
BAD = [
    "SELECT * FROM IDENTIFIER('parquet.`/root/testdata/sf0.001/region.parquet`')", "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home')", "SELECT * FROM default.t", "SELECT * FROM spark_catalog.default.t", "SELECT * FROM parquet.`/root/x`",
    "SELECT * FROM `parquet`.`/x`", "SELECT * FROM json.`/etc/passwd`", "SELECT reflect('java.lang.System', 'getProperty', 'user.home')", "SELECT java_method('a', 'b')", "SELECT try_reflect('a', 'b')", "SELECT builtin.reflect('a', 'b')", "SELECT TRANSFORM(x) USING 'cat' FROM t",
    "SELECT '${env:HOME}'", "SELECT '${system:user.home}'", "SELECT * FROM missing", "TABLE missing", "SELECT input_file_name() FROM t", "SELECT _metadata.file_path FROM t", "SELECT current_user", "SELECT current_user()", "SELECT * FROM python_worker_logs()", "SELECT * FROM read_files('/x')",
    "DROP VIEW t", "DROP TABLE t", "INSERT INTO t VALUES (1)", "CREATE TABLE q AS SELECT 1", "SET a=1", "SELECT 1; SELECT 2", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "FROM t INSERT INTO u SELECT x", "INSERT OVERWRITE DIRECTORY '/tmp/x' USING parquet SELECT 1", "EXECUTE IMMEDIATE 'select 1'",
    "BEGIN SELECT 1; END", "SHOW TABLES", "DESCRIBE t", "EXPLAIN SELECT 1", "CACHE TABLE t", "MERGE INTO t USING u ON 1=1 WHEN MATCHED THEN DELETE", "/* x */ DELETE FROM t", "SELECT '--' AS a, * FROM parquet.`/root/x`", "SELECT '/*' AS a, reflect('x') /* '*/", "SELECT r'\\', reflect('a', '')", "SELECT 'open",
    "SELECT * FROM (WITH a AS (SELECT 1 AS x) SELECT * FROM a) JOIN a", "WITH a AS (SELECT * FROM b), b AS (SELECT 1) SELECT * FROM a", "SELECT (SELECT max(x) FROM hidden.t)", "SELECT x FROM t WHERE x IN (SELECT reflect('a', 'b'))", "SELECT transform(z, v -> reflect('a', 'b')) FROM t",
    "SELECT x FROM t LATERAL VIEW reflect('a', 'b') q AS w", "SELECT * FROM t VERSION AS OF 1", "SELECT * FROM t WITH ('a'='b')", "SELECT * FROM STREAM t", "SELECT :a", "SELECT ?", "", "select", "SELECT own_udf(1)", "SELECT assert_true(false)",
]


@pytest.fixture(scope="module")
def views(spark):
    spark.range(5).selectExpr("id AS x", "id AS y", "array(id) AS z", "'a' AS s", "date'2024-01-01' AS d", "named_struct('q', id) AS st").createOrReplaceTempView("t")
    spark.range(5).selectExpr("id AS x").createOrReplaceTempView("u")
    spark.udf.register("own_udf", lambda x: x)
    yield spark
    for name in ("t", "u"):
        spark.catalog.dropTempView(name)


@pytest.mark.parametrize("sql", GOOD)
def test_allowed(views, sql):
    query(views, sql).collect()


@pytest.mark.parametrize("sql", BAD)
def test_refused(views, sql):
    with pytest.raises(RequestError):
        guarded(views, sql)


def test_only_tables_that_are_named(views):
    assert query(views, "SELECT * FROM u", tables=["u"], limit=2).count() == 2
    with pytest.raises(RequestError):
        guarded(views, "SELECT * FROM t", tables=["u"])


def test_a_table_of_the_catalog_is_no_view(views):
    views.range(3).write.mode("overwrite").saveAsTable("kept")
    with pytest.raises(RequestError):
        guarded(views, "SELECT * FROM kept")
    views.sql("DROP TABLE kept")
