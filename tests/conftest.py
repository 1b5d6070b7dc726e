from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)

from caremill.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return os.environ.get("TEST_SF_DIR", SMALL)


@pytest.fixture(scope="session")
def duck(folder):
    from compare import connect

    return connect(folder)


@pytest.fixture
def tiny_tasks(spark):
    """Makes almost every key too big for one task."""
    spark.conf.set("spark.caremill.rowsPerTask", "3")
    yield
    spark.conf.unset("spark.caremill.rowsPerTask")
