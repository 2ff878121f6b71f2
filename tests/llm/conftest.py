import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(os.path.dirname(HERE))]

from conftest_llm import build  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    return lambda rows: build(spark, rows)
