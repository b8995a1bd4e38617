from __future__ import annotations

import tempfile
import uuid

import pytest

from palabre.session import build_session


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="palabre-tests-")
    session = build_session(
        "palabre-tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=f"{root}/shared",
        spark__sql__warehouse__dir=f"{root}/warehouse",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="palabre-test-")


@pytest.fixture
def name():
    """A table name not used before."""
    return f"t_{uuid.uuid4().hex[:12]}"
