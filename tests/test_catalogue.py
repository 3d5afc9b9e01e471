"""Every query of the catalogue runs; those with a statement give its rows."""

import os

import pytest

from cantor.plans import catalogue, sql
from compare import of_duckdb, of_spark

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    columns, rows = of_spark(catalogue.QUERIES[name](spark, FOLDER))
    assert rows
    if name in sql.ORACLE_SQL:
        wanted_columns, wanted = of_duckdb(sql.ORACLE_SQL[name], FOLDER)
        assert columns == wanted_columns
        assert sum(rows.values()) == sum(wanted.values())
        assert rows == wanted, (list((rows - wanted).items())[:3], list((wanted - rows).items())[:3])


def test_every_statement_has_a_query():
    assert set(sql.ORACLE_SQL) <= set(catalogue.QUERIES)
