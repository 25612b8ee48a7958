"""The queries that SQL can express give the rows of that SQL."""

import pytest
from compare import compare, connect

from quayside.llm.oracle import ORACLE
from quayside.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert compare(spark, connect(FOLDER), QUERIES[name], ORACLE[name], FOLDER) == ""
