import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from roadloom.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="roadloom-warehouse-", dir=tempfile.gettempdir())
    s = build_session("local[4]", app_name="roadloom-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse})
    checkpoint_dir(s, fallback_base=tempfile.gettempdir())
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="roadloom-test-", dir=tempfile.gettempdir())
