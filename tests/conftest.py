import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from harborline.session import build_session  # noqa: E402
from harborline.sinks.tables import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def store(spark, folder):
    return TableStore(spark, f"{folder}/tables", f"t{uuid.uuid4().hex[:12]}_")


@pytest.fixture
def rows():
    def as_set(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return as_set
