"""Every query with an oracle equals it on the smallest tables; the others run."""
import os

import pytest

from oracle_check import compare, duck, types
from telemark.registry import oracles, registered

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registered(), oracles()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, con, SQL[name]) is None
    assert types(df, con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert len(QUERIES[name](spark, SF).limit(1).collect()) == 1


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
