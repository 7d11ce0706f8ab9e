import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import ODD_ROWS, SCHEMA


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
