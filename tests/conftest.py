import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rivulet.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="rivulet-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rivulet-test-")


@pytest.fixture(scope="session")
def query_frame(spark):
    """name -> the registered query's DataFrame on the smallest tables, built once for all tests."""
    import __spark_entry__ as entry
    queries, built = entry.queries(), {}

    def get(name):
        if name not in built:
            built[name] = queries[name](spark, SF_SMALL)
        return built[name]
    return get
