import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from playstats.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture
def small_model(spark):
    # function scope: fixtures.model() is memoised, and a test that removes the
    # materialised folder must not leave later tests with stale file handles
    from playstats.sources import fixtures
    return fixtures.model(spark, SF_SMALL)


def rows(df, *cols):
    """Collect as sorted list of tuples (optionally only some columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple(str(x) for x in t))
