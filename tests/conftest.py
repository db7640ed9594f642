"""One local session for all tests."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from corvane.session import importable

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return importable(session)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
