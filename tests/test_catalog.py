import os

import pytest
from oracle import spark_rows, sql_rows

from sparkbrook.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, name):
    assert spark_rows(catalog.queries()[name](spark, SF)) == sql_rows(catalog.oracles()[name], SF)
