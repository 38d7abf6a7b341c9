import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martlet.session import build_session, tune  # noqa: E402
from martlet.sources.mart import Mart  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture()
def mart(spark, sf_dir):
    return Mart(spark, sf_dir)

