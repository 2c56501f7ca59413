import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daymosaic.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield session
    session.stop()


@pytest.fixture
def plan():
    """Physical plan of a DataFrame as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
