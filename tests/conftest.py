import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

TESTDATA = os.environ.get("REELSCOPE_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from reelscope.session import build_session

    # local[8,4]: up to 4 attempts per task, so injected task failures are retried
    session = build_session(master="local[8,4]", app_name="reelscope-tests", shuffle_partitions=8, driver_memory="12g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf001_dir():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def smoke_dir():
    return f"{TESTDATA}/sf0.001"
