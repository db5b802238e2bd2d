"""Free SQL over registered tables only, judged on the plan that Spark's own parser makes of it.

Nothing is read from the text. The unresolved plan is walked: each kind of node and expression, each relation and each
function must be on a list of allowed ones, so what nobody thought of is refused. The tables are temporary views, which a
name of one part finds before anything in a catalog.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator
from functools import cache
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

MOST_ROWS = 100_000


class RequestError(ValueError):
    """A request that can't be answered as it stands."""


#: The parser's names of nodes that read or reshape rows.
NODES = frozenset(
    "Project Filter Aggregate Join LateralJoin Sort GlobalLimit LocalLimit Offset Distinct Union Except Intersect SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedRelation UnresolvedWith UnresolvedHaving "
    "UnresolvedQualify OneRowRelation LocalRelation UnresolvedInlineTable UnresolvedTableValuedFunction UnresolvedTVFAliases Generate WithWindowDefinition Pivot Unpivot Sample UnresolvedHint ResolvedInlineTable".split()
)
#: The parser's names of expressions. Functions are UnresolvedFunction and have a list of their own.
EXPRESSIONS = frozenset(
    "UnresolvedAttribute UnresolvedStar UnresolvedAlias UnresolvedFunction UnresolvedExtractValue UnresolvedOrdinal UnresolvedNamedLambdaVariable UnresolvedGenerator UnresolvedWindowExpression UnresolvedStarExcept "
    "UnresolvedStarExceptOrReplace Alias MultiAlias AttributeReference Literal Cast And Or Not EqualTo EqualNullSafe LessThan LessThanOrEqual GreaterThan GreaterThanOrEqual In InSubquery ListQuery Exists ScalarSubquery "
    "LateralSubquery IsNull IsNotNull Like ILike LikeAll LikeAny NotLikeAll NotLikeAny RLike Add Subtract Multiply Divide IntegralDivide Remainder UnaryMinus UnaryPositive BitwiseAnd BitwiseOr BitwiseXor BitwiseNot "
    "Concat CaseWhen If SortOrder WindowExpression WindowSpecDefinition WindowSpecReference SpecifiedWindowFrame UnspecifiedFrame CurrentRow UnboundedPreceding UnboundedFollowing LambdaFunction Rollup Cube GroupingSets "
    "CreateNamedStruct CreateStruct NamePlaceholder StringTrim StringTrimLeft StringTrimRight Substring Overlay StringLocate TimestampAdd TimestampDiff CurrentDate CurrentTimestamp Now First Last AnyValue AggregateExpression PercentileCont PercentileDisc Coalesce".split()
)
#: Groups of built-in functions whose results follow from their arguments, and single ones of other groups.
GROUPS = frozenset("datetime_funcs math_funcs string_funcs agg_funcs predicate_funcs map_funcs lambda_funcs hash_funcs array_funcs generator_funcs window_funcs bitwise_funcs json_funcs conditional_funcs conversion_funcs collection_funcs variant_funcs url_funcs struct_funcs csv_funcs".split())
SINGLE = frozenset({"typeof"})
TABLE_FUNCTIONS = frozenset({"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack", "json_tuple"})
#: Names without brackets that say something about the session, and the column that tells files.
HIDDEN = frozenset({"current_user", "session_user", "user", "current_catalog", "current_database", "current_schema", "_metadata"})


@cache
def allowed_functions(spark: SparkSession) -> frozenset[str]:
    infos = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.listBuiltinFunctionInfos()
    return SINGLE | {i.getName() for i in infos if i.getGroup() in GROUPS}


def _items(seq: Any) -> Iterator[Any]:
    for i in range(seq.size()):
        yield seq.apply(i)


def _kind(node: Any) -> str:
    return node.getClass().getSimpleName().rstrip("$")


class Walk:
    """One statement's plan; the first thing that isn't allowed is an error."""

    def __init__(self, spark: SparkSession, tables: Collection[str]):
        self.tables = {name.lower() for name in tables}
        self.functions = allowed_functions(spark)

    def plan(self, node: Any, scope: frozenset[str]) -> None:
        kind = _kind(node)
        if kind not in NODES:
            raise RequestError(f"a query can't have {kind}")
        if kind == "UnresolvedWith":
            for named in _items(node.cteRelations()):
                name = named._1().lower()
                self.plan(named._2(), scope | {name} if node.allowRecursion() else scope)
                scope = scope | {name}
        elif kind == "UnresolvedRelation":
            parts = list(_items(node.multipartIdentifier()))
            if len(parts) != 1 or parts[0].lower() not in scope | self.tables:
                raise RequestError(f"no table {'.'.join(parts)!r}")
            if not node.options().isEmpty() or node.isStreaming():
                raise RequestError("tables are read without options")
        elif kind == "UnresolvedTableValuedFunction":
            self.function(node.name(), TABLE_FUNCTIONS)
        for e in _items(node.expressions().toSeq()):
            self.expression(e, scope)
        for child in _items(node.children().toSeq()):
            self.plan(child, scope)

    def expression(self, e: Any, scope: frozenset[str]) -> None:
        kind = _kind(e)
        if kind not in EXPRESSIONS:
            raise RequestError(f"a query can't have {kind}")
        if kind == "UnresolvedFunction":
            self.function(e.nameParts(), self.functions)
        elif kind == "UnresolvedGenerator":
            self.function(_parts_of(e.name()), self.functions)
        elif kind == "UnresolvedAttribute":
            if hidden := HIDDEN & {p.lower() for p in _items(e.nameParts())}:
                raise RequestError(f"no column {min(hidden)!r}")
        if kind in ("ListQuery", "Exists", "ScalarSubquery", "LateralSubquery"):
            self.plan(e.plan(), scope)
        for child in _items(e.children().toSeq()):
            self.expression(child, scope)

    @staticmethod
    def function(parts: Any, allowed: Collection[str]) -> None:
        names = list(_items(parts)) if hasattr(parts, "apply") else parts
        if len(names) != 1 or names[0].lower() not in allowed:
            raise RequestError(f"no function {'.'.join(names)!r}")


def _parts_of(identifier: Any) -> list[str]:
    return [p for p in (identifier.database().getOrElse(None) if identifier.database().isDefined() else None, identifier.funcName()) if p]


def registered(spark: SparkSession) -> list[str]:
    """The session's temporary views."""
    return [t.name for t in spark.catalog.listTables() if t.isTemporary]


def guarded(spark: SparkSession, sql: str, tables: Collection[str] | None = None) -> str:
    """The statement, if it is one query that reads ``tables`` (the session's temporary views by default) and nothing else.

    Refused are writes, commands and scripts; names of more than one part, paths, files and other schemas; functions of
    users, of reflection and about the session or files; names given as expressions; and ``${``, which Spark replaces by
    settings and variables of the environment before it parses.
    """
    if "${" in sql:
        raise RequestError("no substitution of variables")
    known = registered(spark)
    if tables is not None:
        known = [t for t in known if t.lower() in {x.lower() for x in tables}]
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except PySparkException as e:
        raise RequestError(f"no query: {str(e).splitlines()[0] if str(e) else type(e).__name__}") from e
    Walk(spark, known).plan(parsed, frozenset())
    return sql


def query(spark: SparkSession, sql: str, limit: int = 1_000, tables: Collection[str] | None = None) -> DataFrame:
    return spark.sql(guarded(spark, sql, tables)).limit(max(1, min(MOST_ROWS, limit)))
