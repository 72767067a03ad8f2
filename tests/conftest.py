"""Shared Spark session for the tests (local mode, small shuffle width)."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[*]",
        app_name="tessera-tests",
        shuffle_partitions=8,
        extra={"spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    # The session's own checkpoint folder wins; a fresh temp folder only where none is set.
    if not checkpoint_dir(session):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp"))
    yield session
    session.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp")
