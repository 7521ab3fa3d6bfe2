"""Corpus queries against their SQL in another engine."""

import pytest

from compare import differences, duck
from sluiceway.llm.queries import LLM_ORACLE, LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(LLM_QUERIES[name](spark, SF_DIR), duck(SF_DIR), LLM_ORACLE[name]) == []


def test_queries_of_all_dealt_operators():
    assert [sum(name.startswith(f"op{n}_") for name in LLM_QUERIES) for n in range(1, 14)] == [1] * 13
