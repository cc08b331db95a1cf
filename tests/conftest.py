from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from local_spark import session  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return session()
