import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from plumbline.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("staged")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def meters(spark):
    """Readings of meters, with the values that checks tend to get wrong."""
    rows = [
        (1, "m-1", "2024-05-01", 0.0, "kWh"),
        (2, "m-1", "2024-05-02", -0.0, "kWh"),
        (3, "m-2", None, float("nan"), "KWH"),
        (4, None, "2024-05-02", None, ""),
        (4, "m-3", "2024-13-40", 1e12, "kWh"),
        (None, "m-3", "2024-05-02", 7.25, None),
    ]
    return spark.createDataFrame(rows, "reading int, meter string, day string, amount double, unit string")
