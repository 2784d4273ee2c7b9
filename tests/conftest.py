import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardbook.session import local_session  # noqa: E402
from wardbook.sources.folders import scratch_folder  # noqa: E402

TESTDATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.maxMetadataStringLength": "10000"})
    yield session
    session.stop()


@pytest.fixture
def root(spark):
    """A fresh folder that every executor reaches."""
    return scratch_folder(spark, "test")


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture(scope="session")
def duck():
    def connect(sf_dir):
        connection = duckdb.connect()
        for table in TABLES:
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        return connection

    return connect
