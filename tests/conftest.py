import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skyroute.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("checkpoints")
    session = local_session(8, spark__checkpoint__dir=str(folder), spark__driver__memory="6g", spark__ui__showConsoleProgress="false")
    yield session
    session.stop()
