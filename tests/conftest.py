import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplens.spark import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the environment's defaults when set;
    # shoplens.spark.shared_dir sets a temporary one only when it is unset
    s = get_session("local[4]", shuffle_partitions=4, app_name="shoplens-tests",
                    extra_conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shoplens-wh-")})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="shoplens-t-")
