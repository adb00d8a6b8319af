"""Compare registered queries with their SQL in DuckDB.

``python tests/oracle.py [sf] [name ...]`` prints one line for each query.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, (float, Decimal)):
        value = float(value)
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, name: str, sf_dir: str) -> str:
    """Empty when columns and rows agree."""
    import __spark_entry__ as driver

    df = driver.queries()[name](spark, sf_dir)
    rows = df.collect()
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return "" if rows else "no rows"
    cursor = con.execute(sql)
    columns, expected = [c[0] for c in cursor.description], cursor.fetchall()
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(set(columns) ^ set(df.columns))}"
    spark_kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [(c, t, kinds[c]) for c, t in df.dtypes if spark_kinds.get(t) != kinds[c]]
    got, want = _bag(df.columns, rows), _bag(columns, expected)
    if got != want:
        return f"rows {len(rows)} and {len(expected)}; only here {list((got - want).items())[:2]}; only SQL {list((want - got).items())[:2]}"
    return f"types {odd}" if odd else ""


def main() -> None:
    import __spark_entry__ as driver
    from tallyroll.runtime import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(driver.queries())
    spark = local_session("oracle", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            text = difference(spark, con, name, sf_dir)
        except Exception as error:  # report and go on to the next query
            text = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(text)
        print(f"{'FAIL' if text else 'ok  '} {name} {time.time() - start:.1f}s {text}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
