import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[2]}:{os.environ.get('PYTHONPATH', '')}"  # for the Python workers

from conftest_llm import frame  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, []).limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(0, 1), (2, 0), (7, 0), (9, 1), (None, 1), (8, None), (0, 0)], "doc_id long, quality int")
