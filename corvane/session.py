"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that Spark hands to a Python worker at a time, at most.
BATCH_BYTES = 8 << 20
ROOT = Path(__file__).resolve().parent.parent


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package where it lies in the same place on every machine, and keeps their batches small."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")
    context = spark.sparkContext
    paths = [x for x in (context.environment.get("PYTHONPATH") or "").split(os.pathsep) if x]
    if str(ROOT) not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([str(ROOT), *paths])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``; one is chosen only where executors are threads of this process."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.corvane.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="corvane-")
        spark.conf.set("spark.corvane.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: what it took to compute it isn't done twice."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
