"""Every query with a SQL text gives the same columns, types and rows."""

import pytest
from oracle import differences, plan_of

from reelgrove.plans import ORACLE, QUERIES

ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, small, name):
    result = QUERIES[name](spark, small)
    text = plan_of(result)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert differences(result, ORACLE[name], small) == []


def test_every_query_has_its_sql():
    assert ROWS_ONLY == ["knn_quantised"]  # rows of an approximate search
