from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tallyline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        os.environ.get("BENCH_CPUS", "8"), **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    yield session
    session.stop()
