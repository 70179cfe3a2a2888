import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 8, app_name="kestrel-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kestrel-test-ckpt-"))
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="kestrel-test-")
