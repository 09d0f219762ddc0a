import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feed import Feed  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from encore.session import build_session
    s = build_session("local[4]", app="encore-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="encore-tests-")})
    yield s
    s.stop()


@pytest.fixture
def feed():
    return Feed()
