import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from zonescope.session import LOCAL_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session)
    yield session


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="zonescope-test-")
