import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelforge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="panelforge-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp(request):
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix=f"pf-{request.node.name[:40]}-", dir="/tmp")


SF_SMALL = "/root/testdata/sf0.001"
