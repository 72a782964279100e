import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyloom.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, app="tests", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
