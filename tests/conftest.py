import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from compare import local_spark

    session = local_spark(cores=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows as a frame; column types are given as DDL."""

    def build(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build
