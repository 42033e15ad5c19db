import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewell.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cores="8", memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def pages(spark):
    """Pages from a list of bodies, numbered from 1 in one chain."""

    def make(*bodies, headers=None, stream="s", partition="p"):
        rows = [
            (stream, partition, i + 1, 200, (headers[i] if headers else {}), body) for i, body in enumerate(bodies)
        ]
        schema = "stream string, partition_id string, page_no int, status int, headers map<string,string>, body string"
        return spark.createDataFrame(rows, schema)

    return make
