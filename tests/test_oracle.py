"""Every query of the library with SQL gives the rows that DuckDB gives."""

import os

import duckdb
import pandas as pd
import pytest

from lychgate import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def text(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "null"
    if hasattr(v, "year"):
        return str(pd.Timestamp(v))
    if isinstance(v, str):
        return v
    if str(v) in ("True", "False"):
        return str(v)
    try:
        return repr(float(v))
    except (TypeError, ValueError):
        return str(v)


def rows(df):
    return sorted(tuple(text(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, sf, name):
    ours, theirs = registry.queries()[name](spark, sf).toPandas(), duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["rec_id", "cand_id", "match_key", "net_score"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
