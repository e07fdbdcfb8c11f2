import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rentscope.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    return session


@pytest.fixture
def value(spark):
    """The value of a column expression over one text."""
    from pyspark.sql import functions as F

    def run(build, text):
        frame = spark.createDataFrame([(text,)], "x string")
        return frame.select(build(F.col("x")).alias("y")).first().y

    return run
