import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from leafmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", "tests", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as plain dicts, in the given order."""

    def collect(df, *order):
        if order:
            df = df.orderBy(*order)
        return [r.asDict(recursive=True) for r in df.collect()]

    return collect
