import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gristlane.session import build

    tmp = tmp_path_factory.mktemp("spark")
    s = build("local[4]", 4, "4g", shared=f"file://{tmp}")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
