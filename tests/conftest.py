import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from cohortspark.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        configure(SparkSession.builder.master("local[8]"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("cohortspark.inputPartitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
