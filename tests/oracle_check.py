"""Run queries() against oracle_sql() and compare rows, column by column.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))



def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _key(row):
    return tuple((v is not None, str(type(v)), v) for v in row)


def multiset(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=_key)


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides hold the same rows, else a short account."""
    names = spark_df.columns
    rows = spark_df.collect()
    cursor = con.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    if sorted(names) != sorted(sql_names):
        return f"columns {sorted(names)} vs {sorted(sql_names)}"
    ours = {name: TYPES[kind] for name, kind in spark_df.dtypes}
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    if ours != theirs:
        return f"types {[(n, ours[n], theirs[n]) for n in ours if ours[n] != theirs[n]]}"
    if len(rows) != len(sql_rows):
        return f"rows {len(rows)} vs {len(sql_rows)}"
    ours, theirs = multiset(rows, names), multiset(sql_rows, sql_names)
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}: {a} vs {b}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from bazaarlake.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle-check",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args[1:] or queries:
        started = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
            else:
                problem = None if df.collect() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        seconds = time.time() - started
        kind = "sql" if name in oracles else "rows only"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} ({kind}, {seconds:.2f} s)", flush=True)
        if problem:
            failed += 1
            print("     ", problem)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
