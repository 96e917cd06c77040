"""Every registered query against its DuckDB SQL twin on the smallest tables
(the driver runs the same check at sf0.01): same columns, same rows."""

import duckdb
import pytest

import __spark_entry__ as E
from retailstream.sources.tables import TEST_TABLES
from tests.conftest import SF_SMALL
from tools.compare import canon

NAMES = sorted(E.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.ORACLES) == set(E.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert canon(df.columns, rows) == canon(ocols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["dt", "hr", "new_uv", "uv_ct", "pv_ct", "uj_ct"]
    assert df.count() > 0
