import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 8, **{
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "2",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
    })
    yield session
    session.stop()
