import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from presslens.session import get_spark
    # spark.checkpoint.dir comes from the session configuration when set;
    # otherwise presslens.session creates a local folder (local mode only)
    s = get_spark("local[4]", app="presslens-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="presslens-t-")
