import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stratum.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="tests")
    yield s
    s.stop()


@pytest.fixture()
def run_dir(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    from stratum.session import shared_path
    return shared_path(spark, "tests", fresh=True)
