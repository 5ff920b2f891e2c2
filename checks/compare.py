"""Runs named queries on Spark and their SQL on DuckDB and compares rows exactly.

    python -m checks.compare <data folder> [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pyarrow as pa

from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    return "string" if pa.types.is_string(t) or pa.types.is_large_string(t) else str(t)


def _rows(t: pa.Table) -> list[tuple]:
    names = sorted(t.column_names)
    return sorted(zip(*[t[n].to_pylist() for n in names]), key=repr)


def difference(got: pa.Table, wanted: pa.Table) -> str | None:
    a = {n: _kind(t) for n, t in zip(got.schema.names, got.schema.types)}
    b = {n: _kind(t) for n, t in zip(wanted.schema.names, wanted.schema.types)}
    if a != b:
        return f"schema {sorted(set(a.items()) ^ set(b.items()))}"
    if got.num_rows != wanted.num_rows:
        return f"rows {got.num_rows} for {wanted.num_rows}"
    x, y = _rows(got), _rows(wanted)
    off = [(p, q) for p, q in zip(x, y) if p != q]
    return f"{len(off)} rows differ, first {str(off[0])[:600]}" if off else None


def compare(spark, con, sf: str, name: str) -> tuple[str | None, int, float, float]:
    t = time.time()
    got = QUERIES[name](spark, sf).toArrow()
    t, spark_s = time.time(), time.time() - t
    if name not in ORACLE:
        return None, got.num_rows, spark_s, 0.0
    wanted = con.execute(ORACLE[name]).to_arrow_table()
    return difference(got, wanted), got.num_rows, spark_s, time.time() - t


def main() -> None:
    from checks.session import session

    spark, sf = session(), sys.argv[1]
    con = connect(sf)
    for name in sys.argv[2:] or list(QUERIES):
        try:
            bad, n, s, d = compare(spark, con, sf, name)
            print(f"{'ok ' if bad is None else 'BAD'} {name:24s} {n:7d} rows  spark {s:6.2f}s  sql {d:6.2f}s  {bad or ''}",
                  flush=True)
        except Exception as e:
            print(f"ERR {name:24s} {str(e)[:500]}", flush=True)


if __name__ == "__main__":
    main()
