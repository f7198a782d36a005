"""Order-free comparison of a Spark result with DuckDB over the same tables."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def norm(v) -> str:
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    return repr(v)


def rows(cursor_rows, order) -> list[str]:
    return sorted("|".join(norm(r[i]) for i in order) for r in cursor_rows)


def same(df, con, sql: str) -> None:
    other = con.sql(sql)
    assert sorted(df.columns) == sorted(other.columns)
    names = sorted(df.columns)
    left = rows(df.select(*[f"`{n}`" for n in names]).collect(), range(len(names)))
    right = rows(other.fetchall(), [other.columns.index(n) for n in names])
    assert left == right
