"""Every query against its SQL on the smallest folder."""

from pathlib import Path

import pytest

import __spark_entry__ as entries
from workloads import oracle
from workloads.check import connect, differences
from workloads.queries import ALL

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert ALL.keys() == oracle.SQL.keys() and ALL.keys() <= entries.queries().keys()


@pytest.mark.parametrize("name", list(ALL))
def test_query(spark, db, name):
    assert differences(entries.queries()[name](spark, FOLDER), db, entries.oracle_sql()[name]) == []


def test_entry(spark):
    df = entries.entry(spark)
    assert df.count() == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
