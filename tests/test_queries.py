"""Every registered query against its SQL in DuckDB at the smallest size; those without SQL run."""

import os

import pytest

import __spark_entry__
from tests.oracle import differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
from glossworks.plans import queries as own  # noqa: E402


@pytest.mark.parametrize("name", list(own.QUERIES))
def test_query(spark, name):
    df = own.QUERIES[name](spark, SF)
    if name in own.SQL:
        assert differences(df, own.SQL[name], SF) == ""
    else:
        assert df.count() > 0


def test_entry_and_names(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
