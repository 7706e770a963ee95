"""Queries with an SQL form against DuckDB; every numbered query is registered."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import duck, rows_of  # noqa: E402
from tresoria.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(E.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE) <= set(queries.QUERIES) <= names


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert rows_of(E.queries()[name](spark, SF).toPandas()) == rows_of(duck(SF).sql(E.oracle_sql()[name]).df())
