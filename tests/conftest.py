from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from funnelwright import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.build("tests", "local[8]", 4)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def rows_of():
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
