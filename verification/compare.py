"""Run queries beside their SQL and report where rows or schema differ.

    python -m verification.compare [data folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification.oracles import ORACLES
from verification.queries import QUERIES

TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "string": "VARCHAR"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if names, types and rows (as a bag, values compared exactly) agree."""
    expected = con.execute(sql)
    types = {d[0]: str(d[1]) for d in expected.description}
    rows = expected.fetchall()
    names = sorted(df.columns)
    if names != sorted(types):
        return [f"columns {names} against {sorted(types)}"]
    found = []
    for name, kind in df.dtypes:
        if TYPES.get(kind) != types[name]:
            found.append(f"{name}: {kind} against {types[name]}")
    order = [list(types).index(n) for n in names]
    want = Counter(tuple(_key(r[i]) for i in order) for r in rows)
    got = Counter(tuple(_key(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    if want != got:
        extra, missing = list((got - want).items()), list((want - got).items())
        found.append(
            f"{sum(got.values())} rows against {sum(want.values())}; "
            f"only Spark {extra[:2]}; only SQL {missing[:2]}"
        )
    return found


def _key(value):
    return repr(float(value)) if isinstance(value, (float, Decimal)) else repr(value)


def run(spark: SparkSession, folder: str, names: list[str]) -> bool:
    con = connect(folder)
    good = True
    for name in names:
        start = time.time()
        found = differences(QUERIES[name](spark, folder), con, ORACLES[name])
        good &= not found
        print(f"{name:26} {time.time() - start:6.2f}s {'ok' if not found else found}", flush=True)
    return good


if __name__ == "__main__":
    from spendweave.session import local_session

    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    sys.exit(0 if run(session, data, sys.argv[2:] or list(QUERIES)) else 1)
