import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from countlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="countlens-tests-")
    s = build_session(
        "local[4]",
        app_name="countlens-tests",
        shuffle_partitions=4,
        extra_conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        },
    )
    yield s
    s.stop()
