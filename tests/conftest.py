import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session, shared_dir

    s = local_session("*", 8, "ledgerloom-tests")
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def workdir(tmp_path):
    return str(tmp_path)
