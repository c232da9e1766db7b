"""Run named queries on Spark and DuckDB and compare values, order-insensitive."""

import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, (Decimal, date, datetime)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def compare(spark, sf_dir, name, query, sql, con):
    frame = query(spark, sf_dir)
    ours = normal(frame.columns, [tuple(row) for row in frame.collect()])
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    theirs = normal(names, result.fetchall())
    assert sorted(frame.columns) == sorted(names), (name, frame.columns, names)
    assert len(ours) == len(theirs), (name, len(ours), len(theirs))
    for a, b in zip(ours, theirs):
        assert a == b, (name, a, b)
    return len(ours)


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import local_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    con = connect(sf)
    sqls = oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            rows = compare(spark, sf, name, query, sqls[name], con)
            print(f"ok    {name:32s} {rows:8d} rows {time.time() - started:6.2f}s", flush=True)
        except Exception as error:
            print(f"FAIL  {name:32s} {type(error).__name__}: {str(error)[:600]}", flush=True)
