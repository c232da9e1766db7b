import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, memory="6g")
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    # Show pushed filters in full when a test looks at a plan.
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def sf():
    return SF
