"""Spark rows against DuckDB rows, order-insensitive."""

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{os.path.join(sf_dir, name)}.parquet')")
    return con


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = [str(d[1]) for d in cursor.description]
    return names, kinds, cursor.fetchall()


def ordered(names, rows):
    place = [names.index(n) for n in sorted(names)]
    return Counter(tuple(row[i] for i in place) for row in rows)


SPARK_KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


def differences(df, con, sql, show=3):
    """Empty text when both sides agree, else what differs."""
    names, kinds, duck = duck_rows(con, sql)
    if sorted(names) != sorted(df.columns):
        return f"columns: spark {sorted(set(df.columns) - set(names))} duck {sorted(set(names) - set(df.columns))}"
    spark_kinds = {n: SPARK_KINDS.get(k, k) for n, k in df.dtypes}
    other = {n: (spark_kinds[n], k) for n, k in zip(names, kinds) if spark_kinds[n] != k}
    if other:
        return f"types: {other}"
    ours = ordered(df.columns, [tuple(r) for r in df.collect()])
    theirs = ordered(names, duck)
    if ours == theirs:
        return ""
    return (
        f"{sum(ours.values())} against {sum(theirs.values())} rows; "
        f"only spark {list((ours - theirs).items())[:show]}; only duck {list((theirs - ours).items())[:show]}"
    )
