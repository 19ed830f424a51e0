import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from accesslake.session import local_session

    s = local_session("*", shuffle_partitions=8, app="accesslake-tests")
    yield s
    from accesslake.sources import io

    io.drop_scratch(s)
    s.stop()


@pytest.fixture
def scratch(spark):
    from accesslake.sources import io

    return io.scratch_dir(spark, "test")
