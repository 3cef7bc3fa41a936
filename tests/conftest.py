import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from songloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def evaluate(spark):
    """Value of one column expression."""

    def run(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return run
