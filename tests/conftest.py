from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("runstar-tests")
               .config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
               .config("spark.sql.codegen.wholeStage", "false")  # tiny data: compiling costs more than it saves
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
