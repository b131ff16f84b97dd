"""Shared fixtures: one local Spark session for the whole run."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from imagelake.session import build_session, checkpoint_dir
    s = build_session("local[4]", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="imagelake-test-")
