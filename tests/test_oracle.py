"""Every registered query that SQL can express gives the oracle's rows."""

import pytest
from check_oracle import compare

from acrewise.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(name, spark, sf, duck):
    assert compare(QUERIES[name](spark, sf), duck, ORACLES[name]) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
