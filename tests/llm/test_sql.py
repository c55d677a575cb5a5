"""The queries that have SQL against it."""

import pytest
from compare import differences, duck
from corpusloom.llm.queries import QUERIES
from corpusloom.llm.sql import SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), duck(FOLDER), SQL[name]) == ""
