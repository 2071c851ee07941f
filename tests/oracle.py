"""Compare named queries with their SQL twins in DuckDB.

As a script: ``python tests/oracle.py [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


# Spark type name -> the DuckDB type a twin must return.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def duck_kind(kind: str) -> str:
    return KINDS.get(kind) or kind.upper()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, Decimal):
        return format(value, "f")
    return value


def compare(df, con, sql: str) -> str | None:
    """None if both agree in columns, types and rows; else what differs."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    kinds = dict(zip(names, (str(d[1]).upper().replace(" ", "") for d in theirs.description)))
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = sorted(names)
    ours_kinds = {name: duck_kind(kind) for name, kind in df.dtypes}
    off = {n: (ours_kinds[n], kinds[n]) for n in order if ours_kinds[n] != kinds[n]}
    if off:
        return f"types {off}"
    place = [names.index(n) for n in order]
    want = Counter(tuple(plain(row[i]) for i in place) for row in theirs.fetchall())
    have = Counter(tuple(plain(row[n]) for n in order) for row in df.collect())
    if want != have:
        extra, lost = list((have - want).items()), list((want - have).items())
        return (
            f"{sum(have.values())} rows against {sum(want.values())}; "
            f"only ours {str(extra[:2])[:300]}; only theirs {str(lost[:2])[:300]}"
        )
    return None


def main(names: list[str]) -> int:
    here = os.path.dirname(os.path.abspath(__file__))
    sys.path.insert(0, os.path.dirname(here))
    from __spark_entry__ import oracle_sql, queries
    from tallyframe.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "oracle", "local[8]",
        {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
         "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    runs, twins = queries(), oracle_sql()
    bad = 0
    for name in names or runs:
        started = time.time()
        try:
            df = runs[name](spark, folder)
            if name in twins:
                problem = compare(df, con, twins[name])
                note = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                problem, note = None, f"rows only: {df.count()}"
        except Exception as error:  # report and go on to the next query
            problem, note = error, f"FAILED {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s {note}", flush=True)
    print(f"{bad} of {len(names or runs)} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
