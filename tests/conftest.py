import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cadenza-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.autoBroadcastJoinThreshold": "10m",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate a Column function over a list of texts."""

    def run(function, texts):
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        return [r.out for r in frame.select("i", function(frame.t).alias("out")).orderBy("i").collect()]

    return run
