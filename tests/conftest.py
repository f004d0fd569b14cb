import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from georisk.session import get_session
    ckpt = tempfile.mkdtemp(prefix="georisk-test-ckpt-", dir="/tmp")
    s = get_session("local[4]", app="georisk-tests", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": f"{ckpt}/warehouse"})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
