import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from delaylens.session import get_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = get_session("delaylens-tests", 8, **{"spark.checkpoint.dir": str(folder)})
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()
