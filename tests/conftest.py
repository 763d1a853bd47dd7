import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from profitlens.session import build_session
    scratch = tempfile.mkdtemp(prefix="profitlens-test-")
    s = build_session("local[*]", 8, app_name="profitlens-tests", extra={
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
    })
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="profitlens-case-")
