import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from thalweg.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=int(os.environ.get("TEST_CPUS", "8")), app="thalweg-tests", memory="8g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return os.path.join(os.environ.get("THALWEG_TESTDATA", "/root/testdata"), "sf0.001")
