import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows():
    """Collected rows as sorted tuples, doubles rounded."""

    def collect(df, digits=9):
        def plain(v):
            return round(v, digits) if isinstance(v, float) else v

        return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)

    return collect
