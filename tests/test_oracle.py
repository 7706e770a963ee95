"""Every registered query against its SQL oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import duck, rows_of  # noqa: E402
from tresoria.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries()) and set(catalog.QUERIES) <= set(E.queries())


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert stypes == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    sdf = df.toPandas()
    ddf = rel.df()
    sc, sr = rows_of(sdf)
    dc, dr = rows_of(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) == 3
