import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_llm_data import ODD, make


@pytest.fixture(scope="session")
def odd(spark):
    return make(spark, ODD).cache()


@pytest.fixture(scope="session")
def none(spark):
    return make(spark, []).cache()
