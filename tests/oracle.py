"""Order-insensitive comparison of a Spark result with DuckDB's."""

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool | str):
        return v
    return round(float(v), 7)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def same(df, sql, sf_dir):
    r = connect(sf_dir).sql(sql)
    assert sorted(r.columns) == sorted(df.columns)
    expected = rows_of(r.columns, r.fetchall())
    assert rows_of(df.columns, [tuple(x) for x in df.collect()]) == expected
