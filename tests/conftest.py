import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidewatch.runtime import make_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = make_session(
        "tests", "local[4]", 4, spark__driver__memory="4g", spark__ui__showConsoleProgress="false",
        spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
