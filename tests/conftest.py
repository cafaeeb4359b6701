from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]")
        .appName("lakestar-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # Use the shared checkpoint folder the environment names; only when none
    # is set do the (local) tests pick a private one.
    sc = session.sparkContext
    if not session.conf.get("spark.checkpoint.dir", None) and not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lakestar-tests-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def wh01(spark):
    """The warehouse built over the sf0.01 driver tables (built once)."""
    from lakestar.plans.build import warehouse_for

    return warehouse_for(spark, SF001).build()
