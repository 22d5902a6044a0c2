"""Runs registered queries against their comparison SQL in DuckDB.

    python tests/compare.py [sf or folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from schemaward.workload.inputs import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = df.collect()
    cur = con.execute(sql)
    want, names = cur.fetchall(), [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return None
    left, right = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
    return f"{len(a)} vs {len(b)} rows; spark {left}; sql {right}"


def main():
    from pyspark.sql import SparkSession
    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, sqls, bad = sf if sf.startswith("/") else f"/root/testdata/{sf}", E.oracle_sql(), 0
    con = duck(sf_dir)
    for name, fn in E.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            why = compare(df, con, sqls[name]) if name in sqls else f"(no SQL) {df.count()} rows"
        except Exception as e:
            why = f"ERROR {type(e).__name__} {str(e)[:700]}"
        bad += bool(why)
        print(f"{'ok ' if not why else 'BAD'} {name} {time.time() - t:.1f}s {why or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
