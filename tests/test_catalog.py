"""Every catalogue query against its SQL in DuckDB."""

import duckdb
import pytest

from driftline.plans.catalog import ORACLES, QUERIES

TABLES = "events orders documents embeddings".split()
#: sf0.01: at sf0.001 the probes' steps are hours, so ten of them exceed the day that T5 looks for.
SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def sf_dir():
    return SF_DIR


def rows(found):
    plain = [tuple(None if v != v else v for v in r) for r in found]
    return sorted(plain, key=lambda r: tuple((v is None, 0 if v is None else v) for v in r))


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rel = con.sql(ORACLES[name])
    at = [list(rel.columns).index(c) for c in columns]
    assert sorted(rel.columns) == columns
    assert rows(tuple(r) for r in df.select(*columns).collect()) == rows(tuple(r[i] for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
