"""Read-only SQL over the board tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Statements users may send; the two table pragmas have Spark counterparts.
_READS = re.compile(r"^\s*\(*\s*(select|with|explain|values|from|table)\b", re.IGNORECASE)
_TABLE_INFO = re.compile(r"^\s*pragma\s+table_info\s*\(\s*['\"`]?(\w+)['\"`]?\s*\)\s*;?\s*$", re.IGNORECASE)
_TABLE_LIST = re.compile(r"^\s*pragma\s+table_list\s*;?\s*$", re.IGNORECASE)


class ReadOnlyError(ValueError):
    """The statement is not a plain read."""


# Functions that call into the Java runtime.
_CALLS = {"reflect", "java_method", "try_reflect"}
_WITH_PLAN = {"ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "TableSubquery", "FunctionTableSubqueryArgumentExpression"}


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _nodes(plan):
    """All plan nodes and expressions of a parsed statement as (kind, node), subqueries and common tables included."""
    name = plan.getClass().getSimpleName()
    yield name, plan
    if name == "ExplainCommand":
        yield from _nodes(plan.logicalPlan())
        return
    inner = [] if name.endswith("Command") else _items(plan.innerChildren())
    for child in _items(plan.children()) + inner:
        yield from _nodes(child)
    for expression in _items(plan.expressions()):
        yield from _expressions(expression)


def _expressions(expression):
    name = expression.getClass().getSimpleName()
    yield name, expression
    if name in _WITH_PLAN:
        yield from _nodes(expression.plan())
    for child in _items(expression.children()):
        yield from _expressions(child)


def _refusal(spark: SparkSession, plan) -> str | None:
    """Why a parsed statement is no plain read of the registered tables; None if it is one."""
    nodes = list(_nodes(plan))
    local = {node.alias().lower() for name, node in nodes if name == "SubqueryAlias"}
    for i, (name, node) in enumerate(nodes):
        if name == "ExplainCommand" and i == 0:
            continue
        if "Command" in name or "Insert" in name or name.startswith(("Analyze", "Create", "Drop", "Alter", "Delete", "Update", "Merge", "Replace", "Repair", "Refresh", "Truncate", "Cache", "Load", "Set")):
            return "the statement would change data or settings"
        if "ScriptTransformation" in name:
            return "the statement would run a program"
        if name == "UnresolvedFunction" and _items(node.nameParts())[-1].lower() in _CALLS:
            return "the statement would call into the Java runtime"
        if name == "UnresolvedRelation":
            parts = _items(node.multipartIdentifier())
            if len(parts) != 1 or (parts[0].lower() not in local and not spark.catalog.tableExists(parts[0])):
                return f"{'.'.join(parts)} is no registered table"
    return None


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """Run one read-only statement: SELECT, WITH, VALUES, EXPLAIN or a table pragma."""
    info = _TABLE_INFO.match(text)
    if info:
        return spark.sql(f"DESCRIBE {info.group(1)}")
    if _TABLE_LIST.match(text):
        return spark.sql("SHOW TABLES")
    if not _READS.match(text):
        raise ReadOnlyError("read-only: the statement must start with SELECT, WITH or EXPLAIN")
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    refusal = _refusal(spark, plan)
    if refusal:
        raise ReadOnlyError(f"read-only: {refusal}")
    return spark.sql(text)
