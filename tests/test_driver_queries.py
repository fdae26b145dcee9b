import subprocess
import sys
from pathlib import Path

import pytest
from oracle import compare

from tidemill.plans import driver

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, name):
    compare(spark, driver.queries()[name], driver.oracle_sql()[name], SF)


def test_the_entry_needs_no_session():
    """Queries and SQL are named before a session is there."""
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert q and set(s) <= set(q); from pyspark import SparkContext; assert SparkContext._active_spark_context is None"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr


def test_every_query_has_sql():
    assert set(driver.queries()) == set(driver.oracle_sql())
