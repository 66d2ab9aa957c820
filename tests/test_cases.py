"""Every planted case gives the rows that its SQL states."""

import duckdb
import pytest
from cases import ORACLES, QUERIES


def plain(x):
    return repr(round(x, 9) + 0.0) if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_case(spark, name):
    want = duckdb.sql(ORACLES[name])
    got = QUERIES[name](spark, "").select(*want.columns)
    rows = lambda found: sorted(tuple(plain(x) for x in r) for r in found)
    assert rows(got.collect()) == rows(want.fetchall())
