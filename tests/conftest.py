import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tallyward.session import local_session

    session = local_session("8", partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def bank(spark, smoke_dir):
    from tallyward.plans.bank import Bank

    return Bank(spark, smoke_dir)
