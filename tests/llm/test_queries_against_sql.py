"""The queries that SQL can express, beside DuckDB on the smallest tables."""

import pytest
from compare import compare, connect

from mercato.llm.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_oracle(spark, key):
    ok, note = compare(spark, connect(FOLDER), key, FOLDER, ORACLES[key])
    assert ok, note
