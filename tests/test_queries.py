"""Every registered query against its SQL over the same tables."""

import compare
import pytest

import __spark_entry__ as entry_points
from tripstats.plans import queries as catalog

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection(testdata):
    return compare.connect(testdata)


def test_every_query_of_the_catalog_has_sql():
    assert set(catalog.registered()) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, testdata, connection, name):
    frame = QUERIES[name](spark, testdata)
    sql = ORACLES[name]
    assert compare.type_differences(frame, connection, sql) == {}
    columns, result = compare.spark_rows(frame)
    assert (columns, result) == compare.sql_rows(connection, sql)
    assert result


def test_entry(spark, testdata):
    assert entry_points.entry(spark).columns == ["company_id", "mes_reserva", "total_valor"]
