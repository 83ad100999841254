import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


class StubWarehouse:
    """Silver tables given as in-memory frames, for semantics tests."""

    def __init__(self, spark, silver: dict):
        self.spark, self._silver = spark, silver

    def silver(self, name):
        return self._silver[name]

    bronze = silver


@pytest.fixture
def stub():
    return StubWarehouse
