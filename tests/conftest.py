import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesloom.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="salesloom-test-")
    s = get_spark("local[4]", 4, "salesloom-tests", extra={"spark.checkpoint.dir": scratch})
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
