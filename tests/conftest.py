import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from regcurate.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=os.environ.get("TEST_CPUS", "*"), shuffle_partitions=8, app="regcurate-tests",
                      checkpoint_dir=tempfile.mkdtemp(prefix="regcurate-tests-"))
    yield s
    s.stop()
