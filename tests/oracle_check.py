"""Compare the registered queries with their SQL in DuckDB.

    python tests/oracle_check.py [name-prefix ...] [--sf 0.01]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for row in frame.itertuples(index=False):
        rows.append(tuple(None if pd.api.types.is_scalar(v) and pd.isna(v) else v for v in row))
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {c: str(t) for c, t in sorted(frame.dtypes.items())}


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    import __spark_entry__ as entry

    started = time.time()
    got = entry.queries()[name](spark, folder).toPandas()
    took = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return len(got) > 0, f"rows only: {len(got)} rows, {took:.1f}s"
    want = con.execute(sql).fetchdf()
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return False, f"{len(a)} rows vs {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return False, f"{len(wrong)} of {len(a)} rows differ, e.g. {wrong[0][0]} vs {wrong[0][1]}"
    note = "" if kinds(got) == kinds(want) else f" types {kinds(got)} vs {kinds(want)}"
    return True, f"{len(a)} rows, {took:.1f}s{note}"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from flowguard.session import build_session

    sf = "0.01"
    if "--sf" in argv:
        at = argv.index("--sf")
        sf = argv[at + 1]
        del argv[at : at + 2]
    folder = f"{DATA}/sf{sf}"
    spark = build_session("oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name in entry.queries():
        if argv and not any(name.startswith(p) for p in argv):
            continue
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:400]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
