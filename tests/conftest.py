import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reelframe import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_tables():
    return "/root/testdata/sf0.001"
