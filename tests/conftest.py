import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from tidemark import build_session  # noqa: E402
from tidemark.schemas import LANDED  # noqa: E402
from tidemark.sources import create_tables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    return create_tables(spark, str(tmp_path / "tables"))


@pytest.fixture
def landed(spark):
    """Envelope rows from (entity, ingestion time, payload[, run date])."""

    def build(*rows):
        full = [(r[1], r[0], 2, r[2], r[3] if len(r) > 3 else r[1].date()) for r in rows]
        return spark.createDataFrame(full, LANDED)

    return build
