"""One small session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", sys.path[0])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from terrafield.session import session

    s = session("test", "tests", spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false", spark__driver__memory="3g", spark__checkpoint__dir="file://" + str(tmp_path_factory.mktemp("shared")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
