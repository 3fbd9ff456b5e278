"""Every operator as a runnable query over the given tables, with SQL to check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(query(prepare(spark), str(sf_dir).rstrip("/")))

        run.__name__, run.__doc__ = name, query.__doc__
        _queries[name] = run
        if sql is not None:
            _sql[name] = sql
        return query

    return add


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that two engines' results compare without zones."""

    def column(name: str, type_name: str):
        if type_name == "date":
            return F.date_format(name, "yyyy-MM-dd").alias(name)
        if type_name in ("timestamp", "timestamp_ntz"):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
        return F.col(name)

    return df.select(*[column(n, t) for n, t in df.dtypes])


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from tallystream.registry import (  # noqa: F401
        collecting,
        landing,
        loading,
        measuring,
        modelling,
        reporting,
        scalars,
    )

    return dict(_queries), dict(_sql)
