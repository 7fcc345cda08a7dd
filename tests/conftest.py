from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from tillmart.session import builder  # noqa: E402
from tillmart.sources.stores import FolderStore  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        builder("tests", shuffle_partitions=4)
        .master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(session.conf.get("spark.checkpoint.dir"))
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    return FolderStore(spark, str(tmp_path))


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    changed = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
