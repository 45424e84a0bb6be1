"""Run queries and oracles side by side: `python -m verification.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from ledgerloom.session import build_session
from verification.oracles import ORACLES
from verification.registry import QUERIES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return "null" if value is None else str(value)


def _sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df: DataFrame, con, sql: str) -> str | None:
    """None if both results are the same, else the first difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _sorted_rows(names, result.fetchall())
    got = _sorted_rows(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(expected) != len(got):
        return f"rows {len(got)} != {len(expected)}"
    different = [(g, e) for g, e in zip(got, expected, strict=True) if g != e]
    if different:
        return f"{len(different)} rows differ, first: spark {different[0][0]} duckdb {different[0][1]}"
    return None


def main() -> int:
    arguments = sys.argv[1:]
    sf_dir = arguments.pop(0) if arguments and "/" in arguments[0] else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in arguments or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = compare(df, con, ORACLES[name]) if name in ORACLES else f"rows {df.count()}"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - started:6.2f}s {name}"
              + (f": {problem}" if problem else ""), flush=True)
    print(f"{failed} of {len(arguments or QUERIES)} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
