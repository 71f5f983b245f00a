import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from caselattice.session import build_session

    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__checkpoint__dir="file://" + tempfile.mkdtemp(prefix="checkpoints-"), spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return DATA
