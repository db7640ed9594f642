"""Readers of evidence tables, raw corpora and checkpoint logs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.text import clean
from corvane.operators import records

# Accepted names of the columns that a frequency report needs, in order of preference.
ALIASES = {
    "journal": ["journal"],
    "indication": ["indication"],
    "intervention_type": ["interventiontype", "intervention"],
    "outcome": ["outcomedirection", "outcome", "outcomes"],
    "sample_size": ["samplesize", "sample"],
}
LOG = (
    "type string, source_path string, provider string, model string, started_at string, batch_index long, record_id long, "
    "completed_record_ids array<long>, data map<string,string>"
)


def corpus(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """(file, record_id, record) of text files, each read whole."""
    texts = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    split = records.split_numbered if numbered else records.split_marked
    return texts.select("file", F.posexplode(split(F.col("value"))).alias("at", "record")).select("file", (F.col("at") + 1).alias("record_id"), "record")


def evidence(spark: SparkSession, paths: list[str]) -> DataFrame:
    """CSV, TSV or Parquet tables, one under another by name; cells cleaned, with their ``Source File``."""
    out = None
    for path in paths:
        if path.endswith((".csv", ".tsv")):
            one = spark.read.csv(path, header=True, sep="\t" if path.endswith(".tsv") else ",", multiLine=True, escape='"')
        else:
            one = spark.read.parquet(path)
        names = {c: " ".join(c.lstrip("﻿").split()) for c in one.columns}
        cells = [clean(F.col(f"`{c}`")).alias(n) if t == "string" else F.col(f"`{c}`").alias(n) for (c, t), n in zip(one.dtypes, names.values())]
        one = one.select(*cells, F.lit(path.rsplit("/", 1)[-1]).alias("Source File"))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("at least one input is needed")
    return out


def resolve(columns: list[str]) -> dict[str, str]:
    """The column that stands for each need of a frequency report; an error names what is missing."""
    plain = {re.sub("[^a-z0-9]+", "", c.strip().lower()): c for c in columns}
    found = {need: next((plain[a] for a in names if a in plain), None) for need, names in ALIASES.items()}
    if missing := [need for need, c in found.items() if c is None]:
        raise ValueError("missing columns: " + ", ".join(missing))
    return found


def log(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a checkpoint log, one JSON object a line; lines that don't parse are skipped."""
    rows = spark.read.text(path).select(F.from_json("value", LOG).alias("x")).select("x.*")
    return rows.where("type is not null")
