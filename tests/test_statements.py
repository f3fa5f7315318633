"""Every registered query that has a SQL twin, against it."""

import __spark_entry__ as contract
import pytest
from oracle import differences

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_statement(spark, name):
    query, statement = contract.queries()[name], contract.oracle_sql()[name]
    assert differences(query, statement, spark, SF_DIR) == []
