from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="tidewater-tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def landed(spark, rows):
    """Landed station files: rows of (buoy_id, year, source_stem, text)."""
    return spark.createDataFrame(rows, "buoy_id string, year string, source_stem string, value string")


def write_text(spark, root, buoy_id, year, text, stem="data"):
    from tidewater.sinks.bronze import write_bronze_observations

    return write_bronze_observations(landed(spark, [(buoy_id, year, stem, text)]), root)
