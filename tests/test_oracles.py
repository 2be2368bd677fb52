"""Every registered query against its SQL in DuckDB."""

import duckdb
import pandas as pd
import pytest

from blockwright.plans import queries_families, queries_more  # noqa: F401
from blockwright.plans.adapters import TABLES
from blockwright.plans.queries import ORACLE, QUERIES

from .conftest import DATA


def norm(df):
    def one(x):
        if x is None or (not hasattr(x, "__len__") and pd.isna(x)):
            return None
        return f"{float(x):.9g}" if isinstance(x, float) else str(x)

    df = df[sorted(df.columns)].map(one)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    got, want = norm(QUERIES[name](spark, DATA).toPandas()), norm(duck.execute(ORACLE[name]).df())
    assert list(got.columns) == list(want.columns)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) <= set()
