import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quarterdeck.session import session

    shared = tmp_path_factory.mktemp("shared")
    conf = {"spark__sql__shuffle__partitions": "4", "spark__ui__enabled": "false", "spark__driver__memory": "6g", "spark__checkpoint__dir": str(shared), "spark__ui__showConsoleProgress": "false"}
    found = session("tests", "local[4]", **conf)
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
