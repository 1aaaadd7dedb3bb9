"""Run the registered queries next to their SQL and report differences.

Usage: python tests/compare.py [scale folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_columns, spark_rows, sql_columns, sql_rows) -> str | None:
    a_names, a = rows_of(spark_columns, spark_rows)
    b_names, b = rows_of(sql_columns, sql_rows)
    if a_names != b_names:
        return f"columns {a_names} != {b_names}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference\n   spark {str(x)[:700]}\n   sql   {str(y)[:700]}"
    return None


def main() -> int:
    from chunkloom.session import get_spark

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = get_spark("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            df = run(spark, folder)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - begin
            if name in oracles:
                found = con.execute(oracles[name])
                problem = difference(df.columns, rows, [d[0] for d in found.description], found.fetchall())
                types = dict(df.dtypes)
                sqlt = {d[0]: str(d[1]) for d in found.description}
                note = f"{len(rows)} rows"
                same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
                odd = {c: (t, sqlt[c]) for c, t in types.items() if same.get(t) != sqlt[c]} if not problem else {}
                note += f" types {odd}" if odd else ""
            else:
                problem, note = None, f"{len(rows)} rows, no SQL"
        except Exception as error:
            problem, note, took = f"{type(error).__name__}: {str(error)[:1200]}", "", time.time() - begin
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '} {name} {took:.1f}s {problem or note}", flush=True)
    print("failed", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
