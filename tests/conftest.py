from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from skillgrid.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[8]", shuffle_partitions=8)
    # Tests set their own checkpoint folder (a cluster names a shared one).
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skillgrid-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return Path(tempfile.mkdtemp(prefix="skillgrid-test-"))
