import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from boardlake.session import clear_scratch, local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cores=4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    ship_package(session)
    yield session
    clear_scratch(session)
    session.stop()
