import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="ledgerflow-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never cleared, never reused)."""
    return tempfile.mkdtemp(prefix="ledgerflow-test-")


SF_SMALL = "/root/testdata/sf0.001"
