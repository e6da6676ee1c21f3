import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegate.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def put(tmp_path):
    """Write a file into the inbox of the test."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()

    def write(name, text, encoding="utf-8"):
        (inbox / name).write_bytes(text.encode(encoding))
        return str(inbox / name)

    write.inbox = str(inbox)
    return write


def values(df, *names):
    return [tuple(r) if len(r) > 1 else r[0] for r in (df.select(*names) if names else df).collect()]
