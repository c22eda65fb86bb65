import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# raw tables of the test runs go to a fresh folder
os.environ.setdefault("CLUTCHFORGE_RAW_DIR", tempfile.mkdtemp(prefix="clutchforge-tests-"))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clutchforge.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="clutchforge-tests")
    yield s
