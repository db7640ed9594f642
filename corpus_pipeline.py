"""The corpus pipeline over ``documents``: five of the training-data operators, one after another.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows that its
predecessor kept, and returns a table with the columns of ``documents``; the last
one returns the packed pieces. Each result is written to the shared folder as
Parquet and read again as the next one's input. ``n_chars`` follows the text
where a stage shortens it.

1. toxicity: documents that score as toxic go.
2. line dedup: of a line that ten documents or more hold, the first stays.
3. SimHash near-dedup: one document of each group of near-copies stays.
4. decontamination: benchmark passages are cut out, mostly covered documents go.
5. packing: the pieces of what is left, in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import decontaminate, line_dedup, packing, simhash, toxicity
from corvane.llm.common import col, discard, scratch, table, written
from corvane.session import importable


def _recount(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, where there is such a column, as long as the text is."""
    if "n_chars" not in docs.columns:
        return docs
    n = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*((n.alias(c) if c == "n_chars" else col(c)) for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(importable(spark), sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return _recount(line_dedup.dedup_lines(docs, keep="first"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return simhash.dedup(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recount(decontaminate.decontaminate(docs, table(importable(spark), sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("packing", pack),
]

#: No SQL trains a classifier, hashes shingles or tokenises; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the whole pipeline makes of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        out = None
        with scratch(lambda: out):  # a stage's own tables go once its result is written
            out = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        docs = before = out
    return docs
