import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from tailfold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tailfold-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
