"""Holds a query's rows against its SQL oracle."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def rows(frame) -> tuple[list[str], list[tuple]]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    plain = [tuple(round(float(x), 6) if isinstance(x, float) else x for x in r) for r in frame.itertuples(index=False)]
    return list(frame.columns), sorted(plain, key=repr)


def same(df, con, sql: str) -> None:
    got, wanted = rows(df.toPandas()), rows(con.sql(sql).df())
    assert got[0] == wanted[0]
    assert len(got[1]) == len(wanted[1])
    assert [(a, b) for a, b in zip(got[1], wanted[1]) if a != b][:3] == []
