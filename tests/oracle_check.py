"""Run registered queries beside their oracle statements and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


ORACLE_SECONDS: list[float] = []


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, build, sql: str, sf_dir: str) -> str | None:
    """None when both results agree, else what differs."""
    frame = build(spark, sf_dir)
    got = frame.collect()
    mark = time.time()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    ORACLE_SECONDS.append(time.time() - mark)
    if sorted(frame.columns) != sorted(names):
        return f"columns: {sorted(frame.columns)} != {sorted(names)}"
    mine, theirs = _rows(frame.columns, got), _rows(names, want)
    if mine != theirs:
        extra = sorted(set(mine) - set(theirs))[:2]
        missing = sorted(set(theirs) - set(mine))[:2]
        return f"rows {len(mine)} vs {len(theirs)}\n  only spark: {extra}\n  only oracle: {missing}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    from plazalake.config import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, build, oracles[name], sf_dir)
                note = "ok" if problem is None else f"DIFF {problem}"
            else:
                note = f"rows only: {build(spark, sf_dir).count()}"
                problem = None
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, note = error, f"ERROR {type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{name:40s} {time.time() - start:6.2f}s (oracle {ORACLE_SECONDS[-1] if ORACLE_SECONDS else 0:5.2f}s) {note}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
