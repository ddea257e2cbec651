import contextlib
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retailweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8)
    yield session
    session.stop()


@pytest.fixture
def plan():
    """The physical plan of a frame as text."""

    def text(df, mode="simple"):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain(mode)
        return out.getvalue()

    return text


def rows(df):
    """The rows of a frame in a fixed order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
