import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    import __spark_entry__  # noqa: F401  (sends functions to workers by value)
    from chunkloom.session import get_spark

    session = get_spark(
        "tests",
        f"local[{os.environ.get('TEST_CPUS', '8')}]",
        **{
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
def small_blocks(monkeypatch):
    """Blocks of three rows, so that every document of a test spans several."""
    from chunkloom.operators import segments

    monkeypatch.setattr(segments, "BLOCK_ROWS", 3)
