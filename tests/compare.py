"""Run a query on Spark and on DuckDB over one folder and describe where they differ."""

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(_plain(r[i])) for i in order) for r in rows))


def spark_kind(dtype):
    return {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
            "date": "DATE", "timestamp_ntz": "TIMESTAMP"}.get(dtype, dtype)


def difference(spark, con, folder, query, sql, types=True):
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    kinds = {d[0]: str(d[1]) for d in res.description}
    want = rows_of(cols, res.fetchall())
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(cols)}"
    if types:
        odd = {c: (k, kinds[c]) for c, k in df.dtypes if spark_kind(k) != kinds[c]}
        if odd:
            return f"types {odd}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first: {sorted(cols)} spark {bad[0][0]} duck {bad[0][1]}"
    return None
