"""Every registered query against its SQL twin, under two session time zones."""

import pytest
from conftest import TESTDATA

import __spark_entry__ as entry_module
from wardbook.plans import oracle, registry

SF_DIR = f"{TESTDATA}/sf0.001"
SQL = oracle.statements()
SPARK_TYPES = {
    "BIGINT": "bigint",
    "VARCHAR": "string",
    "INTEGER": "int",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def queries():
    return registry.bind()


def test_every_query_has_a_twin(queries):
    assert set(queries) == set(SQL) and set(queries) <= set(entry_module.queries())


def test_entry_returns_the_monthly_metrics(spark):
    assert entry_module.entry(spark).count() == 80


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_its_twin(spark, zone, duck, queries, name):
    frame = queries[name](spark, SF_DIR)
    cursor = duck(SF_DIR).execute(SQL[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: SPARK_TYPES[str(d[1])] for d in cursor.description}
    expected = cursor.fetchall()
    assert {f.name: f.dataType.simpleString() for f in frame.schema} == types
    actual = [tuple(row[c] for c in names) for row in frame.collect()]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)
