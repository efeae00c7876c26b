import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from equilibra.session import local_session, shared_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=8, app="equilibra-tests")
    shared_dir(session)  # tests set their own shared folder when none is configured
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_bundles(spark):
    """The session fixture at sf0.001, materialised once for the session."""
    import __spark_entry__ as entry

    path = os.path.join(shared_dir(spark), "bundles_sf0001")
    entry.session_bundles(spark, SF_SMALL).write.mode("overwrite").parquet(path)
    return path
