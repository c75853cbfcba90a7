"""Every registered query of the library against its oracle, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from tidemark.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(df: pd.DataFrame) -> list[tuple]:
    def value(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x) or x is pd.NA:
            return "~"
        return f"{float(x):.6g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(pd.Timestamp(x)) if hasattr(x, "year") else str(x)

    return sorted(tuple(value(x) for x in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    if name not in catalog.ORACLES:
        assert len(got)
        return
    want = duck.execute(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
