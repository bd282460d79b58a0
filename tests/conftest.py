import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

START = datetime(2024, 1, 1)
TX_SCHEMA = (
    "transaction_id string, user_id string, timestamp timestamp_ntz, amount double, "
    "transaction_type string"
)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("ledgerlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_tx(spark):
    """Rows of (id, user, hours after the start or a moment, amount[, type])."""

    def build(rows):
        full = []
        for tid, user, when, amount, *kind in rows:
            if isinstance(when, (int, float)):
                when = START + timedelta(hours=when)
            amount = None if amount is None else float(amount)
            full.append((tid, user, when, amount, kind[0] if kind else "transfer"))
        return spark.createDataFrame(full, TX_SCHEMA)

    return build
