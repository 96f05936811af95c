from __future__ import annotations

import pytest

from lakeproof.session import clear_scratch, local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", app="lakeproof-tests")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.001"
