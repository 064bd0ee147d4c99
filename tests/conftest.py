import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from perigee.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = local_session(4, app="tests", **{"spark.sql.shuffle.partitions": "4"})
    session.conf.set("perigee.scratch.dir", str(scratch))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
