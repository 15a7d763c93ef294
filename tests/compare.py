"""Order-insensitive comparison of a registered query with its SQL equivalent."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def compare(spark, con, sf_dir, query, sql):
    """None when equal, else a description of the difference."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}; first {got[1][:1]} {want[1][:1]}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"{got[0]}\n spark {a}\n sql   {b}"
    return None


if __name__ == "__main__":
    sys.path[:0] = ["/root/repo", "/root/repo/tests"]
    from conftest import make_session

    import __spark_entry__ as entry

    spark = make_session()
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    con = duck(sf)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            diff = compare(spark, con, sf, query, oracles[name])
        except Exception as error:  # report and go on
            diff = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if diff is None else 'DIFF'} {name} {time.time() - began:.1f}s", flush=True)
        if diff:
            print("    " + diff[:1500], flush=True)
