"""Declared validation statements: SQL over the rows that a run has staged for a source, asked before the run's status changes.

A statement selects from ``staged`` the rows that must not be there; it passes if there are none. Spark parses it first, and only a query is let
through: one statement, no command or write anywhere in it, no table but ``staged`` and its own common table expressions, and
no function that calls into the Java virtual machine. ``column NOT IN (query)`` is run by cases of NULL, so that it is a join on equal values.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession

from tidegate.session import use_here

STAGED = "staged"
AT_ONCE = 4
CLOSED = {"reflect", "java_method", "try_reflect"}
PASSED, FAILED, REFUSED, ERROR = "PASSED", "FAILED", "REFUSED", "ERROR"
IN_QUERY = re.compile(r"(NOT\s+)?IN\s*\((.*)\)", re.IGNORECASE | re.DOTALL)
RESULT = "source_id long, status string, violations long, message string"


def _elements(spark: SparkSession, many) -> Iterator:
    return iter(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(many))


def _walk(spark: SparkSession, plan) -> Iterator[tuple]:
    """All nodes of a parsed plan with whether they are expressions, those of subqueries and common table expressions too."""
    java, catalyst = spark._jvm.java.lang.Class, "org.apache.spark.sql.catalyst."
    kinds = {name: java.forName(catalyst + name) for name in ("expressions.Expression", "expressions.SubqueryExpression", "plans.logical.UnresolvedWith")}
    waiting = [(plan, False)]
    while waiting:
        node, expression = waiting.pop()
        yield node, expression
        if expression:
            if kinds["expressions.SubqueryExpression"].isInstance(node):
                waiting.append((node.plan(), False))
        else:
            waiting.extend((e, True) for e in _elements(spark, node.expressions()))
            if kinds["plans.logical.UnresolvedWith"].isInstance(node):
                waiting.extend((relation._2(), False) for relation in _elements(spark, node.cteRelations()))
        waiting.extend((child, expression) for child in _elements(spark, node.children()))


def refusal(spark: SparkSession, statement: str, known: Collection[str] = (STAGED,)) -> str | None:
    """Why a statement may not run; None if it is a query over the ``known`` tables alone. Nothing is run to find out."""
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    except Py4JJavaError as problem:
        return "it cannot be parsed: " + str(problem.java_exception.getMessage()).strip().split("\n")[0]
    except PySparkException as problem:
        return "it cannot be parsed: " + str(problem).strip().split("\n")[0]
    tables, own = set(), {name.lower() for name in known}
    logical = "org.apache.spark.sql.catalyst.plans.logical."
    writing = [spark._jvm.java.lang.Class.forName(logical + n) for n in ("Command", "ParsedStatement", "CompoundPlanStatement")]
    for node, expression in _walk(spark, plan):
        name = node.getClass().getSimpleName()
        if expression:
            if name == "UnresolvedFunction" and str(node.nameParts().last()).lower() in CLOSED:
                return f"it calls {node.nameParts().last()}"
        elif any(kind.isInstance(node) for kind in writing):
            return f"it is no query ({name})"
        elif name == "UnresolvedRelation":
            tables.add(".".join(str(part) for part in _elements(spark, node.multipartIdentifier())).lower())
        elif name in ("UnresolvedTableValuedFunction", "UnresolvedTVFAliases", "RelationTimeTravel", "ScriptTransformation"):
            return f"it reads from elsewhere ({name})"
        elif name == "UnresolvedWith":
            own |= {str(relation._1()).lower() for relation in _elements(spark, node.cteRelations())}
    other = sorted(tables - own)
    return f"it reads {', '.join(other)}" if other else None


def _place(node) -> tuple[int, int] | None:
    """Where a parsed node stands in its statement."""
    first, last = node.origin().startIndex(), node.origin().stopIndex()
    return (first.get(), last.get() + 1) if first.isDefined() and last.isDefined() else None


def _negated_in(spark: SparkSession, statement: str) -> tuple[int, int, str] | None:
    """The last ``column NOT IN (query)`` of a statement: where it starts and ends, and the same by cases."""
    last = None
    for node, expression in _walk(spark, spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)):
        if not expression or node.getClass().getSimpleName() != "Not" or node.child().getClass().getSimpleName() != "InSubquery":
            continue
        values = list(_elements(spark, node.child().values()))
        if len(values) != 1 or values[0].getClass().getSimpleName() != "UnresolvedAttribute":
            continue
        value, rest = _place(values[0]), _place(node.child())
        if value is None or rest is None or statement[value[1] : rest[0]].strip():
            continue
        found = IN_QUERY.fullmatch(statement[slice(*rest)])
        if found is None or last and last[0] > value[0]:
            continue
        column, asked = statement[slice(*value)], f"(\n{found[2]}\n)"
        cases = (
            f"(CASE WHEN {column} IN {asked} THEN FALSE WHEN {column} IS NULL THEN (SELECT IF(count(*) = 0, TRUE, NULL) FROM {asked} AS _asked(_value))"
            f" ELSE (SELECT IF(count(_value) < count(*), NULL, TRUE) FROM {asked} AS _asked(_value)) END)"
        )
        last = (value[0], rest[1], cases if found[1] else f"(NOT {cases})")
    return last


def by_cases(spark: SparkSession, statement: str) -> str:
    """The statement with each ``column NOT IN (query)`` spelled by cases: found, NULL, or a NULL among the query's rows.

    As it stands, Spark compares each row with each of the query's, or sends these to all executors whole, since a NULL on either side leaves
    NOT IN unknown. What is found without NULLs is a join on equal values, and two numbers of the query's rows tell the rest.
    The cases keep what is unknown as NULL, also where Spark takes it for false: in ``(a NOT IN (...)) IS NULL``.
    """
    while found := _negated_in(spark, statement):
        start, end, cases = found
        statement = statement[:start] + cases + statement[end:]
    return statement


@contextmanager
def query_over(spark: SparkSession, statement: str, tables: Mapping[str, DataFrame]) -> Iterator[DataFrame]:
    """A statement that ``refusal`` lets through, over tables by their names; its result can be read inside the block."""
    views = {name: f"{name}_{uuid4().hex}" for name in tables}
    try:
        for name, view in views.items():
            tables[name].createOrReplaceTempView(view)
        named = ", ".join(f"`{name}` AS (TABLE `{view}`)" for name, view in views.items())

        def over(text: str) -> DataFrame:
            return spark.sql(f"WITH {named} SELECT * FROM (\n{text}\n)")

        result = over(statement)
        try:
            cases = over(by_cases(spark, statement))
        except AnalysisException:  # a query that takes columns from around it may not fit into the cases
            cases = result
        yield cases if cases.dtypes == result.dtypes else result
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def _judged(spark: SparkSession, source_id: int, statement: str, rows: Callable[[int], DataFrame | None]) -> tuple:
    text = statement.strip().rstrip(";")
    if why := refusal(spark, text):
        return source_id, REFUSED, None, f"the statement is refused: {why}."
    staged = rows(source_id)
    if staged is None:
        return source_id, PASSED, 0, None
    try:
        with query_over(spark, text, {STAGED: staged}) as violations:
            n = violations.count()
    except Exception as problem:  # noqa: BLE001  whatever a declared statement does wrong is its result
        return source_id, ERROR, None, f"the statement fails: {str(problem).strip().splitlines()[0]}"
    return (source_id, FAILED, n, f"{n} rows violate it.") if n else (source_id, PASSED, 0, None)


def validate(spark: SparkSession, statements: Mapping[int, str], rows: Callable[[int], DataFrame | None]) -> DataFrame:
    """One row per source with a statement: source_id, status, violations and message.

    ``rows`` gives the staged rows of a source, or None if it has none. The statements run side by side; one number of each comes back.
    """
    with ThreadPoolExecutor(AT_ONCE, initializer=use_here, initargs=(spark,)) as pool:
        found = list(pool.map(lambda item: _judged(spark, *item, rows), sorted(statements.items())))
    return spark.createDataFrame(found, RESULT)
