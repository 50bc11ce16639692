"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from aerocast.catalog.oracle import ORACLE
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert not set(oracle_sql()) - set(queries())
    assert set(ORACLE) == {name for name in queries() if name != "pipeline" and not name.startswith("op")}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, db, name):
    ok, note = compare(queries()[name](spark, SF), db, oracle_sql()[name])
    assert ok, note
