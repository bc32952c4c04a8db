"""Comparison of a query with its DuckDB twin, as the driver does it."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        source = p + "/*.parquet" if os.path.isdir(p) else p
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{source}'")
    return c


def rows(frame) -> list[str]:
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(repr, frame.where(frame.notna(), None).itertuples(index=False, name=None)))


def same(spark_frame, sql: str, sf_dir: str) -> None:
    got, want = spark_frame.toPandas(), duck(sf_dir).execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
