import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from jobstar.session import get_spark
    s = get_spark("jobstar-tests", master="local[*]", shuffle_partitions=8,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="jobstar-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="jobstar-test-")
