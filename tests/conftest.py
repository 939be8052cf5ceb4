import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from samples import SMALL, payload  # noqa: E402

from tallyrock.schema import PAYLOAD_FIELDS, names  # noqa: E402
from tallyrock.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def folder(tmp_path):
    """A new folder path as text, not yet there."""
    return str(tmp_path / uuid.uuid4().hex)


@pytest.fixture(scope="session")
def bronze(spark):
    """Builds Bronze rows from changes to a typical event; at is the ingestion time."""
    from pyspark.sql import functions as F

    from tallyrock.schema import BRONZE_FIELDS, PAYLOAD_DDL

    def build(*events, at="2025-04-01 10:00:00"):
        rows = []
        for event in events:
            event = dict(event)
            stamp = event.pop("at", at)
            full = payload(**event)
            rows.append((*[full[name] for name in names(PAYLOAD_FIELDS)], stamp))
        frame = spark.createDataFrame(rows, f"{PAYLOAD_DDL}, stamp STRING")
        return frame.select(
            *names(PAYLOAD_FIELDS),
            F.to_date("stamp").alias("ingestion_date"),
            F.to_timestamp("stamp").alias("ingestion_time"),
            F.lit("test").alias("source"),
        ).select(*names(BRONZE_FIELDS))

    return build
