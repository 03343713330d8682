import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskframe.session import build_session  # noqa: E402
from riskframe.sources.tables import sites  # noqa: E402

DATA = os.environ.get("RISKFRAME_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4",
                            spark__driver__memory="6g", spark__checkpoint__dir=f"{shared}/scratch",
                            spark__sql__warehouse__dir=f"{shared}/warehouse")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return DATA


@pytest.fixture(scope="session")
def all_sites(spark, data_dir):
    return sites(spark, data_dir).persist()
