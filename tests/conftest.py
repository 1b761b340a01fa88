import os
import sys

import pytest

_TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(_TESTS))
# Python workers import test-module functions by name (local mode inherits env).
os.environ["PYTHONPATH"] = os.pathsep.join(
    [_TESTS, os.path.dirname(_TESTS), os.environ.get("PYTHONPATH", "")])

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quern.session import get_session
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    # Tests set their own shared folder (the cluster would name it).
    s = get_session("local[4]", shuffle_partitions=4, app_name="quern-tests",
                    conf={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
