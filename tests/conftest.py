from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from mercastar.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "mercastar-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__sql__debug__maxToStringFields="1000",
        spark__sql__maxMetadataStringLength="10000",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("catalog")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
