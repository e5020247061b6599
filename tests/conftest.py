import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    built = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    built.sparkContext.setLogLevel("ERROR")
    return built


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.01"
