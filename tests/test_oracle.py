"""Every registered query against its DuckDB SQL twin, on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import check, duck  # noqa: E402

from retail_rows import SF_SMALL  # noqa: E402

from mercato import oracle  # noqa: E402
from mercato.plans import catalog  # noqa: E402

QUERIES = {name: fn for name, fn in entry.queries().items() if name in catalog.queries()}
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) >= 45


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = check(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    out = df.collect()
    assert len(out) == 1
    assert df.columns == ["revenue", "units", "invoices", "avg_ticket", "lines", "products"]
