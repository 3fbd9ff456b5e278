"""Bounded, read-only SQL over the session's temporary views.

A statement has to pass two tests. Its words: it starts like a query and holds none of the
blocked words. Its plan, as Spark resolves it and before anything runs: only the node kinds
below, no table or file but the given views, and no call that leaves SQL.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator, Sequence

from pyspark import InheritableThread
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, Row, SparkSession

from tallystream.operators.filters import checked_limit
from tallystream.schemas import MAX_QUERY_ROWS, MAX_QUERY_SECONDS

# --- fixed values: how a statement may start, and words it must not contain -------
STARTS = ["select", "with", "show", "describe", "desc", "explain"]
BLOCKED_WORDS = [
    "insert", "alter", "create", "drop", "truncate", "delete", "update", "optimize", "system", "grant",
    "revoke", "attach", "detach", "rename", "kill",
]
# --- end of fixed values ------------------------------------------------------------

PLAN_NODES = {
    "Aggregate", "CTERelationDef", "CTERelationRef", "Deduplicate", "Distinct", "Except", "Expand", "Filter", "Generate",
    "GlobalLimit", "Intersect", "Join", "LateralJoin", "LocalLimit", "LocalRelation", "Offset", "OneRowRelation",
    "Pivot", "Project", "Range", "ResolvedHint", "Sort", "SubqueryAlias", "Union", "UnionLoop", "UnionLoopRef", "View",
    "Window", "WithCTE",
}
OUTSIDE_CALLS = {"CallMethodViaReflection", "TryReflect", "PythonUDF", "ScalaUDF", "HiveSimpleUDF", "HiveGenericUDF"}
COMMANDS = re.compile(r"(?is)^(show\s+(tables|views)|desc(ribe)?\s+(table\s+)?(?P<view>\w+))$")
EXPLAIN = re.compile(r"(?is)^explain(\s+(extended|formatted|cost|simple))?\s+(?P<query>(select|with)\b.*)$")


class RefusedStatement(ValueError):
    """The statement is not one read-only query over the given views."""


def checked_words(sql: str) -> str:
    """The statement without the semicolons after it. A blocked word counts wherever it stands,
    in a text literal too."""
    text = re.sub(r"[;\s]+$", "", sql).lstrip()
    words = re.findall(r"\w+", text.lower())
    if not words or words[0] not in STARTS:
        raise RefusedStatement(f"a statement begins with one of {', '.join(STARTS)}")
    if blocked := sorted(set(words) & set(BLOCKED_WORDS)):
        raise RefusedStatement(f"not allowed here: {', '.join(blocked)}")
    if ";" in text:
        raise RefusedStatement("one statement at a time")
    return text


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _check_calls(expression, views: set[str]) -> None:
    if _kind(expression) in OUTSIDE_CALLS:
        raise RefusedStatement("calls outside SQL are not allowed")
    if "Subquery" in _kind(expression) or _kind(expression) in ("Exists", "ListQuery"):
        _check_plan(expression.plan(), views)
    for child in _items(expression.children()):
        _check_calls(child, views)


def _check_plan(plan, views: set[str]) -> None:
    if _kind(plan) not in PLAN_NODES:
        raise RefusedStatement(f"only queries over {', '.join(sorted(views)) or 'the given views'} are allowed")
    if _kind(plan) == "View":
        if plan.desc().identifier().table().lower() not in views:
            raise RefusedStatement(f"unknown view {plan.desc().identifier().table()}")
        return
    for expression in _items(plan.expressions()):
        _check_calls(expression, views)
    for child in _items(plan.children()):
        _check_plan(child, views)
    if _kind(plan) == "WithCTE":
        for definition in _items(plan.cteDefs()):
            _check_plan(definition, views)


def checked_query(spark: SparkSession, text: str, views: set[str], args: dict | None = None) -> DataFrame:
    """The query, resolved but not run, if its plan passes."""
    try:
        df = spark.sql(text, args=args)
    except (AnalysisException, ParseException) as error:
        raise RefusedStatement(str(error).split("\n")[0]) from error
    _check_plan(df._jdf.queryExecution().analyzed(), views)
    return df


def readonly_sql(
    spark: SparkSession, sql: str, limit: int = 100, args: dict | None = None,
    views: Sequence[str] | None = None, max_rows: int | None = MAX_QUERY_ROWS,
) -> DataFrame:
    """Run a statement that passes; at most `limit` rows, and never more than max_rows.

    views: the views it may read, all temporary ones of the session by default. A query that has
    a limit of its own is left to it, under max_rows. max_rows: None for no such bound.
    """
    text = checked_words(sql)
    known = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary} if views is None else {v.lower() for v in views}
    if text.lower().startswith(("select", "with")):
        df = checked_query(spark, text, known, args)
        own = re.search(r"(?i)\slimit\s", f" {text} ")
        rows = max_rows if own else checked_limit(limit, max_rows)
        return df if rows is None else df.limit(rows)
    if (inner := EXPLAIN.match(text)) is not None:
        checked_query(spark, inner["query"], known, args)
    elif (command := COMMANDS.match(text)) is None or (command["view"] or "").lower() not in known | {""}:
        raise RefusedStatement("show tables, show views, and describe of a given view are the commands allowed")
    df = spark.sql(text, args=args)
    return df if max_rows is None else df.limit(max_rows)


class TimeLimit(RuntimeError):
    """The statement was stopped after its time was up."""


def run_readonly_sql(spark: SparkSession, sql: str, seconds: float = MAX_QUERY_SECONDS, **options) -> list[Row]:
    """The rows of `readonly_sql`, or TimeLimit after `seconds`.

    The statement's jobs carry a tag of their own and are cancelled by it, so whatever else runs in the session
    goes on. Options are those of `readonly_sql`; max_rows bounds what comes to the driver.
    """
    context, tag = spark.sparkContext, f"readonly-{uuid.uuid4().hex}"
    done, late = threading.Event(), threading.Event()

    def watch() -> None:
        if done.wait(seconds):
            return
        late.set()
        # A statement may start further jobs after one was cancelled.
        while not done.wait(0.2):
            context.cancelJobsWithTag(tag)

    context.addJobTag(tag)
    watcher = InheritableThread(target=watch, daemon=True)
    watcher.start()
    try:
        rows = readonly_sql(spark, sql, **options).collect()
    except Exception as error:
        if late.is_set():
            raise TimeLimit(f"stopped after {seconds} seconds") from error
        raise
    finally:
        done.set()
        context.removeJobTag(tag)
        watcher.join()
    return rows
