"""Every registered query against its SQL twin."""

import pytest

from plantflow import oracle, registry
from tests import compare

NAMES = sorted(registry.queries())
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    return compare.database(compare.data("sf0.01"))


def test_every_query_has_a_twin():
    assert NAMES == sorted(oracle.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_matches(spark, con, name):
    df = registry.queries()[name](spark, compare.data("sf0.01"))
    sql = oracle.oracle_sql()[name]
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == described
    names, got = compare.spark_rows(df)
    expected_names, expected = compare.duck_rows(con, sql)
    assert names == expected_names
    assert len(got) == len(expected) > 0
    assert got == expected
