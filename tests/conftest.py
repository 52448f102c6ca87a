import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from msgsift.session import checkpoint_dir, get_spark

    s = get_spark("local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "8g"})
    checkpoint_dir(s)  # a scratch folder of its own, because the setting is unset in tests
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="msgsift-test-")


SF = "/root/testdata/sf0.001"
