import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from riskweave.session import build_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from check_queries import duck as connect
    return connect(DATA)


@pytest.fixture()
def ts():
    from datetime import datetime, timedelta

    def at(seconds=0.0, base=datetime(2024, 3, 1, 12)):
        return base + timedelta(seconds=seconds)
    return at
