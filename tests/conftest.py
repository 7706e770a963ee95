import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from tresoria.session import build_session
    wh = tempfile.mkdtemp(prefix="tresoria-wh-", dir="/tmp")
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="tresoria-tests",
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()
