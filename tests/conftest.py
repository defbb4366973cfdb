import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session("local[4]", app="tidemark-tests", shuffle_partitions=4, extra={
        "spark.driver.memory": "6g", "spark.sql.ui.retainedExecutions": "1", "spark.ui.retainedJobs": "1",
        "spark.ui.retainedStages": "1", "spark.ui.retainedTasks": "1"})
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def nothing_kept(request):
    """After each test that used Spark its cached and written tables go."""
    yield
    if "spark" in request.fixturenames:
        from tidemark.session import drop_written
        s = request.getfixturevalue("spark")
        s.catalog.clearCache()
        drop_written(s)
