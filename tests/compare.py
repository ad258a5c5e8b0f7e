"""Order-insensitive comparison of a DataFrame with a DuckDB result."""

from collections import Counter

import duckdb


def connect(folder, tables):
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(row[i] for i in order) for row in result.fetchall()), kinds


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())
