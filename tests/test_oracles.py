"""Every registered query against its SQL, on whole tables held as folders of several files."""

import os
import tempfile

import pytest
from compare import compare, connect

from flowtables.plans.catalog import QUERIES
from flowtables.plans.oracles import ORACLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables(spark):
    folder = tempfile.mkdtemp(prefix="flowtables-test-")
    for name in os.listdir(SF):
        spark.read.parquet(f"{SF}/{name}").repartition(3).write.parquet(f"{folder}/{name}")
    return folder


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, tables, name):
    assert compare(QUERIES[name](spark, tables), con, ORACLES[name]) == []
