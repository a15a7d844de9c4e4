"""Shared Spark session for the test suite (local, small shuffle count, UI off)."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from strata.session import local_session

    s = local_session("strata-tests", cores="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint area (never reused, never deleted)."""
    import uuid

    from strata.session import shared_scratch

    return shared_scratch(spark, f"test-{uuid.uuid4().hex[:10]}")
