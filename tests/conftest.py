import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from voltlake.session import build_session
    warehouse = tempfile.mkdtemp(prefix="voltlake-wh-")
    s = build_session("local[4]", shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": warehouse,
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="voltlake-ckpt-"),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="voltlake-test-")
