"""Compares a query with its DuckDB SQL, as the driver does."""

import os

import duckdb

DATA = os.environ.get("WEFTLINE_DATA", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(data=DATA):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return con


def rows(cols, found):
    def plain(v):
        if isinstance(v, float):
            return "nan" if v != v else repr(v)
        if hasattr(v, "isoformat"):
            return v.isoformat()[:19].removesuffix("T00:00:00")
        return str(v)

    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in found)


def differ(spark, query, sql, data=DATA):
    """'' where both agree, else what differs."""
    df = query(spark, data)
    con = connect(data).execute(sql)
    want_cols = [d[0] for d in con.description]
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} and {sorted(want_cols)}"
    want, got = rows(want_cols, con.fetchall()), rows(df.columns, df.collect())
    if want == got:
        return ""
    a, b = [x for x in got if x not in set(want)], [x for x in want if x not in set(got)]
    return f"{len(got)} and {len(want)} rows; only in Spark {len(a)}: {a[:3]}; only in SQL {len(b)}: {b[:3]}"
