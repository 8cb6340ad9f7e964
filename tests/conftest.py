import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from garimpo.session import build_session, tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = tune(build_session("tests", 4, "4g"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of text under the given column names."""

    def make(columns, rows):
        return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{c}` string" for c in columns))

    return make
