import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
