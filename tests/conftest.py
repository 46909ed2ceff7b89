import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from milesbase.session import build_session, ship_package

    scratch = tempfile.mkdtemp(prefix="milesbase-tests-")
    s = build_session("local[4]", shuffle_partitions=4, app_name="milesbase-tests",
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.local.dir": os.path.join(scratch, "local")})
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s
    s.stop()
