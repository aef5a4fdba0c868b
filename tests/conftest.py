from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from agrilake.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").appName("tests")
    builder = builder.config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    builder = builder.config("spark.driver.memory", "4g")
    # Tiny inputs: tracking the Python line of every column costs more than running the plans.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    builder = builder.config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    session = configure(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
