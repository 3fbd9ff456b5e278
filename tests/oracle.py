"""Run queries on Spark and their SQL on DuckDB, and compare whole results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda r: tuple(map(repr, r))
    )


def compare(df, con, sql: str) -> str | None:
    """None when both results are equal, else what differs."""
    result = con.execute(sql)
    want_columns, want = _sorted([d[0] for d in result.description], result.fetchall())
    got_columns, got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference\n  spark {g}\n  duck  {w}"
    return None


def main(sf_dir: str, *names: str) -> None:
    import __spark_entry__ as entry
    from tallystream.session import build_session

    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
                                 "spark.ui.enabled": "false",
                                 "spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                problem = compare(df, con, sql[name])
                label = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                label = f"rows {df.count()}"
        except Exception as error:  # report and go on
            label = f"FAILED {type(error).__name__} {str(error)[:1500]}"
        bad += not label.startswith(("ok", "rows"))
        print(f"{name:32} {time.time() - started:6.2f}s {label}", flush=True)
    print("problems", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
