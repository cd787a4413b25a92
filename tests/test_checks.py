"""Every registered query against its SQL."""

import oracle
import pytest

from arealoom.checks import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert oracle.differences(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_oracle_types_are_plain(con):
    plain = {"BIGINT", "INTEGER", "DOUBLE", "VARCHAR", "BOOLEAN"}
    for name, sql in ORACLES.items():
        types = {row[1] for row in con.execute("DESCRIBE " + sql).fetchall()}
        assert types <= plain, name


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
