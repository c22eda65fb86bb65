"""Every registered query of the library runs and is compared with the DuckDB oracle."""

import re

import pytest

import __spark_entry__ as E
from oracle.check import compare, duck

from .conftest import SF_SMALL

QUERIES = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "is_upset" in df.columns


def test_every_query_has_an_oracle_or_is_documented():
    qs, oq = E.queries(), E.oracle_sql()
    assert set(oq) <= set(qs)
    assert {n for n in set(qs) - set(oq) if not re.match(r"op\d+_|pipeline$", n)} == set()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, name):
    con = duck(SF_SMALL)
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    du = con.execute(E.oracle_sql()[name]).df()
    r = compare(sp, du)
    assert r["match"], r
