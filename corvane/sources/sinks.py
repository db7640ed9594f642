"""Writers of cleaned corpora, tables and manifests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "NaN"


def cleaned_record(index: Column, journal: Column, pmid: Column, doi: Column, year: Column, title: Column, body: Column) -> Column:
    """A record of the cleaned corpus: rule, number and journal, identifiers, title and body."""

    def shown(c: Column) -> Column:
        return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(MISSING))

    head = F.concat(F.lit("["), index.cast("string"), F.lit("]  "), journal)
    ids = F.concat(F.lit("PMID: "), shown(pmid), F.lit("  DOI: "), shown(doi), F.lit("  Year: "), shown(year))
    return F.concat_ws("\n", F.lit("=" * 68), head, ids, title, F.lit(""), body)


def corpus(df: DataFrame, record: Column, path: str) -> None:
    """Records as text, one after another, in as many files as there are partitions."""
    df.select(record.alias("value")).write.text(path)


def table(df: DataFrame, path: str) -> None:
    """CSV with a header; missing values as ``NaN``."""
    df.write.csv(path, header=True, nullValue=MISSING, quoteAll=False)


#: Ids that a manifest lists; a longer list belongs in a table.
MANIFEST_IDS = 1_000_000


def manifest(ids: DataFrame, key: str, source: str, **metadata) -> str:
    """JSON document of the distinct ids of failed records, ascending; empty if there are none. Too many of them raise an error."""
    kept = [r[0] for r in ids.select(key).distinct().orderBy(key).limit(MANIFEST_IDS + 1).collect()]
    if len(kept) > MANIFEST_IDS:
        raise ValueError(f"more than {MANIFEST_IDS} ids: write them as a table")
    return json.dumps({"source_path": source, "record_ids": kept, "metadata": metadata}, sort_keys=True) if kept else ""
