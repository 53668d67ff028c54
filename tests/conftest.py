import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gleaner.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", app="tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a frame as a set-like sorted list of tuples in column order."""

    def collect(df, *columns):
        out = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in out.collect()), key=repr)

    return collect
