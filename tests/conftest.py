from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from recurra.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(folder / "checkpoints"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
