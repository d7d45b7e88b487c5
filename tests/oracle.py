"""Compare a query's rows with its SQL's, as sets with counts, columns by name."""

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in found)


def difference(spark, con, query, sql, sf_dir):
    """None, or what differs."""
    df = query(spark, sf_dir)
    want = con.sql(sql)
    if sorted(df.columns) != sorted(want.columns):
        return f"columns {sorted(df.columns)} and {sorted(want.columns)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    types = dict(zip(want.columns, map(str, want.types), strict=True))
    wrong = [(c, t, types[c]) for c, t in df.dtypes if t in kinds and kinds[t] != types[c]]
    got, expected = rows(df.columns, df.collect()), rows(want.columns, want.fetchall())
    if got != expected:
        return f"{sum(got.values())} and {sum(expected.values())} rows; only here {str(list((got - expected).items())[:2])[:600]}; only in SQL {str(list((expected - got).items())[:2])[:600]}"
    return f"types {wrong}" if wrong else None
