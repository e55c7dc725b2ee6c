"""One local session for all tests; small slices are a fixture of the tests that need them."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logharbor.session import SLICE_ROWS_KEY, MAX_GROUP_ROWS_KEY, build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark_sql_shuffle_partitions="4", spark_driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_groups(spark):
    """Slices of seven rows, and join keys with more than seven rows are spread."""
    spark.conf.set(SLICE_ROWS_KEY, "7")
    spark.conf.set(MAX_GROUP_ROWS_KEY, "7")
    yield 7
    spark.conf.unset(SLICE_ROWS_KEY)
    spark.conf.unset(MAX_GROUP_ROWS_KEY)
