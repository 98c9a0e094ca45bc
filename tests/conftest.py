import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quarry.session import build_session, clear_scratch

    shared = str(tmp_path_factory.mktemp("shared"))
    s = build_session(
        "local[8]", app_name="quarry-tests", shuffle_partitions=8, extra={"spark.checkpoint.dir": shared}
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    clear_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
