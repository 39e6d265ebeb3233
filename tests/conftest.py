import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from sensorloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "sensorloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """Readings of the smallest scale."""
    from sensorloom.plans import views

    return views.load(spark, SMALL).cache()


@pytest.fixture(scope="session")
def medium(spark):
    from sensorloom.plans import views

    return views.load(spark, MEDIUM).cache()


@pytest.fixture
def reading(spark):
    """Readings from tuples (id, gateway, device, temperature, humidity, seconds, class)."""
    from datetime import datetime, timedelta

    from sensorloom import constants as C

    def make(*rows):
        start = datetime(2024, 1, 1)
        return spark.createDataFrame(
            [(i, g, d, t, h, start + timedelta(seconds=s), c) for i, g, d, t, h, s, c in rows], C.READING
        )

    return make
