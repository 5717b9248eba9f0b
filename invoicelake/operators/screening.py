"""Screening of SQL texts before they run: one read-only query, no comments, a bounded result.

Works on a table of logged texts and uses native expressions only. It is one of two layers; the
credential the query runs under should be read-only as well.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from invoicelake.schema import ROW_LIMIT

# --- fixed values: words that may not appear outside a text literal -------------------
FORBIDDEN = (
    "insert", "update", "delete", "merge", "drop", "create", "alter", "truncate", "grant",
    "revoke", "copy", "call", "exec", "execute", "attach", "install", "load", "pragma", "set",
    "use", "optimize", "vacuum", "refresh", "read_csv", "read_parquet", "read_json", "read_files",
)
# --------------------------------------------------------------------------------------

# Calls by which a query of Spark reaches Java methods, and the formats a path can be read by as if it were a table.
SPARK_CALLS = ("reflect", "try_reflect", "java_method")
PATH_FORMATS = ("text", "csv", "json", "xml", "parquet", "orc", "avro", "binaryfile", "jdbc", "delta")

# (?U): letters, digits and blanks of all scripts, so look-alike blanks hide nothing
_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_FENCES = r"(?iU)^```(?:sql)?|```$"
# What Spark reads as text or as a quoted name. An escaped character is replaced first, so it ends nothing.
_ESCAPED = r"(?s)\\."
_QUOTED = r"""'[^']*'|"[^"]*"|(`)[^`]*`"""
_RAW = r"""(?i)\br['"]"""
_READ = r"(?iU)^(select|with)\b"
_WORDS = rf"(?iU)\b({'|'.join(FORBIDDEN)})\b"
# What is quoted as a name stays, literals go: names are looked at as Spark resolves them, quoted or not.
_LITERAL = r"""('[^']*'|"[^"]*")|(`[^`]*`)"""
_CALLS = rf"(?iU)(?<![\w`])`?({'|'.join(SPARK_CALLS)})`?\s*\("
_SCRIPT = r"(?iU)\busing\s*''"
# a format, a quoted class name, or more parts than a table has, and then a quoted name
_PATH = (rf"(?iU)(?<![\w`.])`?(?:{'|'.join(PATH_FORMATS)})`?\s*\.\s*`"
         r"|`[^`]*\.[^`]*`\s*\.\s*`|(?:\w+\s*\.\s*){4,}`")
_LIMIT = r"(?iU)\blimit\s+(\d+|all)\s*$"
_OFFSET = r"(?iU)\s*\b(offset\s+\d+)\s*$"


class UnsafeSQL(ValueError):
    """The text is not a single bounded read."""


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, _BLANKS, "")


def screen_queries(log: DataFrame, column: str = "sql", row_limit: int | None = ROW_LIMIT) -> DataFrame:
    """Add ``blocked_because`` (NULL when allowed) and ``safe_sql`` (NULL when blocked).

    Words and marks are looked for with literals and quoted names blanked out by the rules of Spark's lexer (both
    quotes, escapes, back quotes); a doubled quote inside a literal reads as two literals side by side. A raw literal
    in a text with a backslash is refused, because escapes mean nothing in it. A missing or too large LIMIT at the
    end, before an OFFSET if there is one, becomes the row limit, written into the original text.
    """
    bare = _trim(F.regexp_replace(_trim(F.regexp_replace(_trim(F.col(column)), _FENCES, "")), ";+$", ""))
    word = F.regexp_extract("_code", _WORDS, 1)
    call = F.regexp_extract("_names", _CALLS, 1)
    limit = F.regexp_extract("_code", _LIMIT, 1)
    blocked = (
        F.when(F.coalesce(F.col("_code"), F.lit("")) == "", "empty text")
        .when(F.col("_code").contains(";") | F.col("_code").contains("--")
              | F.col("_code").contains("/*"), "several statements or a comment")
        .when(~F.col("_code").rlike(_READ), "not a SELECT")
        .when(word != "", F.concat(F.lit("forbidden word: "), F.lower(word)))
        .when(call != "", F.concat(F.lit("forbidden word: "), F.lower(call)))
        .when(F.col("_code").rlike(_SCRIPT), "a script")
        .when(F.col("_names").rlike(_PATH), "a table named by a path")
        .when(F.col("_sql").rlike(_RAW) & F.col("_sql").contains("\\"), "a raw literal and a backslash")
    )
    bounded = F.col("_sql") if row_limit is None else F.concat(
        F.when(limit == "", F.concat(F.col("_sql"), F.lit(f"\nLIMIT {row_limit}")))
        .when(limit.try_cast("decimal(38,0)") <= row_limit, F.col("_sql"))
        .otherwise(F.regexp_replace("_sql", _LIMIT, f"LIMIT {row_limit}")),
        F.when(F.col("_offset") == "", "").otherwise(F.concat(F.lit(" "), F.col("_offset"))))
    blanked = F.regexp_replace(F.regexp_replace("_sql", _ESCAPED, "__"), _QUOTED, "''$1")
    named = F.regexp_replace(F.regexp_replace("_sql", _ESCAPED, "__"), _LITERAL, "$2")
    rows = log.withColumn("_sql", bare).withColumns({"_code": blanked, "_names": named})
    if row_limit is not None:
        rows = rows.withColumn("_offset", F.regexp_extract("_code", _OFFSET, 1)).withColumns({
            name: F.when(F.col("_offset") == "", F.col(name)).otherwise(F.regexp_replace(name, _OFFSET, ""))
            for name in ("_sql", "_code")})
    return (
        rows.withColumn("blocked_because", blocked)
        .withColumn("safe_sql", F.when(F.col("blocked_because").isNull(), bounded))
        .drop("_sql", "_code", "_names", "_offset")
    )


def guard(spark: SparkSession, sql: str, row_limit: int = ROW_LIMIT) -> str:
    """The safe form of one text, or UnsafeSQL."""
    row = screen_queries(spark.createDataFrame([(sql,)], "sql string"), row_limit=row_limit).first()
    if row.blocked_because:
        raise UnsafeSQL(row.blocked_because)
    return row.safe_sql


# What a query over named tables is made of, before and after its names are resolved.
READ_NODES = frozenset((
    "Aggregate", "CTERelationDef", "CTERelationRef", "Deduplicate", "Distinct", "Except", "Expand", "Filter", "Generate",
    "GlobalLimit", "Intersect", "Join", "LateralJoin", "LocalLimit", "LocalRelation", "Offset", "OneRowRelation", "Pivot",
    "Project", "Range", "ResolvedInlineTable", "Sample", "Sort", "Subquery", "SubqueryAlias", "Union", "UnresolvedHaving",
    "UnresolvedHint", "UnresolvedInlineTable", "UnresolvedRelation", "UnresolvedSubqueryColumnAliases",
    "UnresolvedTableValuedFunction", "UnresolvedTVFAliases", "UnresolvedWith", "UnionLoop", "UnionLoopRef", "Unpivot", "View",
    "Window", "WithCTE", "WithWindowDefinition"))
# Groups of Spark's own functions that compute something from their arguments and do nothing else. The rest (calls of
# methods, the name of the file or user, sleeping) is in none of them.
READ_GROUPS = frozenset(f"{g}_funcs" for g in (
    "agg", "array", "bitwise", "collection", "conditional", "conversion", "datetime", "generator", "hash", "json", "lambda",
    "map", "math", "operator", "predicate", "string", "struct", "window"))
# a table of the catalog, under its name
STORED = ("LogicalRelation", "HiveTableRelation", "DataSourceV2Relation")
REFUSED_EXPRESSIONS = re.compile(
    r"CallMethodViaReflection|UDF|UDAF|UDTF|ApplyFunctionExpression|Unresolved\w*Identifier|^Invoke$|NewInstance")


def _items(found) -> list:
    """A Scala sequence as a list."""
    return [found.apply(i) for i in range(found.size())]


class _Review:
    """Walks a plan and refuses all that is not listed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.state = spark, spark._jsparkSession.sessionState()
        self.identifier = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier
        self.known: dict[str, bool] = {}
        self.ctes: set[str] = set()

    def resolved(self, top) -> None:
        """The same after analysis: all that is not below a view or a stored table of the catalog."""
        nodes = [top]
        while nodes:
            node = nodes.pop()
            kind = node.getClass().getSimpleName()
            below = _items(node.children())
            if kind == "SubqueryAlias" and below[0].getClass().getSimpleName() in STORED:
                continue
            if kind not in READ_NODES:
                raise UnsafeSQL(f"not a query over named tables: {kind}")
            if kind != "View":
                for expression in _items(node.expressions()):
                    nodes += self.expression(expression)
                nodes += below

    def plan(self, top) -> None:
        nodes = [top]
        while nodes:
            node = nodes.pop()
            kind = node.getClass().getSimpleName()
            if kind not in READ_NODES:
                raise UnsafeSQL(f"not a query over named tables: {kind}")
            if kind == "View":             # a named table: what it is made of is not the text's doing
                continue
            if kind == "UnresolvedWith":
                relations = [r._2() for r in _items(node.cteRelations())]
                self.ctes |= {r.alias().lower() for r in relations}
                nodes += relations
            elif kind == "UnresolvedRelation":
                self.table([str(part) for part in _items(node.multipartIdentifier())])
            elif kind == "UnresolvedTableValuedFunction":
                self.function([str(part) for part in _items(node.name())])
            for expression in _items(node.expressions()):
                nodes += self.expression(expression)
            nodes += _items(node.children())

    def expression(self, top) -> list:
        """Checks an expression and returns the plans inside it."""
        found, plans = [top], []
        while found:
            e = found.pop()
            kind = e.getClass().getSimpleName()
            if REFUSED_EXPRESSIONS.search(kind):
                raise UnsafeSQL(f"not a query over named tables: {kind}")
            if kind == "UnresolvedFunction":
                self.function([str(part) for part in _items(e.nameParts())])
            elif kind == "UnresolvedGenerator":
                self.function([e.name().funcName()])
            elif kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression"):
                plans.append(e.plan())
            found += _items(e.children())
        return plans

    def table(self, parts: list[str]) -> None:
        if len(parts) == 1 and parts[0].lower() in self.ctes:
            return
        name = ".".join("`" + part.replace("`", "``") + "`" for part in parts)
        try:
            there = self.spark.catalog.tableExists(name)
        except Exception:   # a name of more parts than any catalog here has
            there = False
        if not there:
            raise UnsafeSQL(f"not a known table: {name}")

    def function(self, parts: list[str]) -> None:
        name = parts[-1].lower()
        if name not in self.known:
            info = self.state.functionRegistry().lookupFunction(self.identifier(name))
            if not info.isDefined():
                info = self.state.tableFunctionRegistry().lookupFunction(self.identifier(name))
            self.known[name] = info.isDefined() and info.get().getSource() == "built-in" and (
                info.get().getGroup() in READ_GROUPS or name == "range") and not REFUSED_EXPRESSIONS.search(
                    info.get().getClassName())
        if len(parts) > 1 or not self.known[name]:
            raise UnsafeSQL(f"not a function a query may call: {'.'.join(parts)}")


def require_read(spark: SparkSession, sql: str) -> None:
    """Refuse a text that Spark itself reads as more than a query over named tables.

    Spark ends literals and resolves names by rules of its own, so the words of a text decide nothing here. First the
    parsed plan is walked, so that no file is listed and no call is folded while names are resolved, then the resolved one:
    only listed kinds of nodes, tables and views the catalog knows, and Spark's own functions of listed groups may be there.
    """
    review = _Review(spark)
    parsed = review.state.sqlParser().parsePlan(sql)
    review.plan(parsed)
    skip = spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()
    review.resolved(review.state.executePlan(parsed, skip).analyzed())


def run_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Screen a text and run it over the named tables (or over views that exist already)."""
    from invoicelake.sources.catalog import register_views

    register_views(tables or {})
    safe = guard(spark, sql)
    require_read(spark, safe)
    return spark.sql(safe)
