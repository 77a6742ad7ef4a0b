import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tripmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, "4g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared"))
    )
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def get(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return get
