import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from memweave.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", "memweave-tests", {"spark.sql.shuffle.partitions": "8",
                                                     "spark.driver.memory": "8g"})
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
