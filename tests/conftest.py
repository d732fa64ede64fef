import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    scratch = tempfile.mkdtemp(prefix="tidemark-tests-")
    s = build_session("local[4]", app_name="tidemark-tests", shuffle_partitions=4, extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
    })
    s.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    yield s


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="tidemark-case-")
