import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelkit.session import get_session
    s = get_session("local[4]", app="panelkit-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelkit-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def no_job_group_left(request):
    """A job group that a test sets must not collect the jobs of the tests after it."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture(scope="session")
def tmpdir_session():
    return tempfile.mkdtemp(prefix="panelkit-test-")
