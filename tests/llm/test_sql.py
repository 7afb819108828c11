"""Every SQL twin of the corpus operators against its query."""

import pytest

from dqspark.llm import queries
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    r = compare(spark, name, SF, duck(SF))
    assert r["rows"] == r["oracle_rows"] and r["cols_match"] and r["hash_match"], r
