"""Extraction over arriving records, as a structured stream that can be resumed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corvane.functions import extract


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records (record_id, text) from Parquet files as they arrive."""
    return spark.readStream.schema("record_id long, text string").parquet(path)


def extracted(records: DataFrame) -> DataFrame:
    """All fields of each record, once for each id."""
    once = records.dropDuplicates(["record_id"])
    return once.select("record_id", *(c.alias(n) for n, c in extract.all_fields(F.col("text")).items()))


def run(records: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends what has arrived to a Parquet table; the checkpoint resumes after a stop."""
    return extracted(records).writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(out)
