import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from triagelake.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame(ddl, *rows): a small literal DataFrame."""

    def make(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return make
