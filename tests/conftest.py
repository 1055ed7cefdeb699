import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kickledger.session import build_session, shared_path  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    return build_session("local[4]", shuffle_partitions=4)


@pytest.fixture
def scratch(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    return shared_path(spark, "test")
