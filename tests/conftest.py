from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from txnlake.session import local_session  # noqa: E402
from txnlake.sources.lake import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", name="txnlake-tests")
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    return Lake(spark, tempfile.mkdtemp(prefix="run-"))


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
