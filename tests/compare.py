"""Run registered queries beside their SQL and report differences."""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return str(value)


def normal(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    result = con.execute(sql)
    want = normal([d[0] for d in result.description], result.fetchall())
    got = normal(df.columns, [tuple(row) for row in df.collect()])
    if want[0] != got[0]:
        return f"columns {got[0]} instead of {want[0]}"
    if want[1] == got[1]:
        return None
    missing = [r for r in want[1] if r not in set(got[1])][:2]
    extra = [r for r in got[1] if r not in set(want[1])][:2]
    return f"{len(got[1])} rows instead of {len(want[1])}; missing {missing}; extra {extra}"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from medallion.session import build_session

    sf_dir = sys.argv[1]
    only = set(sys.argv[2:])
    spark = build_session("compare", "local[8]", spark_sql_shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = duck(sf_dir), entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                verdict = difference(df, con, oracle[name]) or "same"
            else:
                verdict = f"{len(df.collect())} rows, no SQL"
        except Exception as error:
            verdict = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name}: {verdict} ({time.time() - started:.1f}s)", flush=True)


if __name__ == "__main__":
    main()
