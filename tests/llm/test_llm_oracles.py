"""The operators' queries against their SQL, and that all of them and the pipeline are registered."""

import re

import pytest
from compare import compare, connect

import __spark_entry__ as registered
from flowtables.llm.catalog import LLM_QUERIES
from flowtables.llm.oracles import LLM_ORACLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(LLM_QUERIES[name](spark, SF), connect(SF), LLM_ORACLES[name]) == []


def test_all_are_registered():
    names = set(registered.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names
