"""Run registered queries beside their SQL in DuckDB: python check.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from tallyloom.plans import load_all
from tallyloom.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if hasattr(value, "is_finite"):  # Decimal
        return float(value)
    return value


def canonical(columns: list[str], rows) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, query, sf_dir: str) -> str:
    df = query.build(spark, sf_dir)
    ours = canonical(df.columns, [tuple(x) for x in df.collect()])
    if query.sql is None:
        return f"rows {len(ours[1])}"
    cur = con.execute(query.sql)
    names = [d[0] for d in cur.description]
    theirs = canonical(names, cur.fetchall())
    if ours[0] != theirs[0]:
        return f"COLUMNS {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"ROWCOUNT {len(ours[1])} != {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if bad:
        return f"VALUES {len(bad)} of {len(ours[1])}, first {bad[0]}"
    return f"ok {len(ours[1])}"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    failed = 0
    for name, q in load_all().items():
        if chosen and not any(name == c or (c.endswith("*") and name.startswith(c[:-1])) for c in chosen):
            continue
        start = time.time()
        try:
            outcome = compare(spark, con, q, sf_dir)
        except Exception as error:  # report and go on with the next query
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        good = outcome.startswith(("ok", "rows"))
        failed += not good
        print(f"{'  ' if good else '!!'} {name:34s} {time.time() - start:6.2f}s  {outcome}", flush=True)
    print("failed", failed)


if __name__ == "__main__":
    main()
