"""Batched calls of an external model, with passes over what is still open.

A backend turns a batch of records into answers; it runs in Arrow batches on the
executors. A batch that fails is halved until single records are left; what a pass
does not answer is open for the next one, and what no pass answers gets a note.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.session import written

SCHEMA = "record_id long, answer string, calls int"


class Backend(Protocol):
    def call(self, batch: list[dict]) -> str:
        """A JSON text ``{"rows": [{"source_index": ..., ...}]}``, or an exception."""


class RuleBackend:
    """A deterministic stand-in: the first number and the first word of a text."""

    def __init__(self, drop_every: int = 0, fail_over: int = 0) -> None:
        self.drop_every, self.fail_over = drop_every, fail_over

    def call(self, batch: list[dict]) -> str:
        if self.fail_over and len(batch) > self.fail_over:
            raise TimeoutError(f"{len(batch)} records are too many")
        rows = []
        for x in batch:
            if self.drop_every and len(batch) > 1 and x["record_id"] % self.drop_every == 0:
                continue
            number, word = re.search(r"\d+", x["text"]), re.search(r"\w+", x["text"])
            rows.append({"source_index": x["record_id"], "number": number[0] if number else "", "word": word[0] if word else ""})
        return "Here it is: " + json.dumps({"rows": rows})


def parse_rows(text: str) -> list[dict]:
    """Rows of an answer: an object with ``rows``, a list, or a single row; text around the JSON is skipped."""
    for opening, closing in ("{}", "[]"):
        start, end = text.find(opening), text.rfind(closing)
        if 0 <= start < end:
            try:
                value = json.loads(text[start : end + 1])
            except ValueError:
                continue
            rows = value.get("rows", [value]) if isinstance(value, dict) else value
            return [x for x in (rows if isinstance(rows, list) else [rows]) if isinstance(x, dict)]
    return []


def answers(backend: Backend, batch: list[dict]) -> tuple[dict[int, str], int]:
    """Answers by record id, and the calls made; a failed batch is halved."""
    try:
        rows = parse_rows(backend.call(batch))
    except Exception:
        if len(batch) == 1:
            return {}, 1
        half = len(batch) // 2
        (a, m), (b, n) = answers(backend, batch[:half]), answers(backend, batch[half:])
        return a | b, 1 + m + n
    wanted = {x["record_id"] for x in batch}
    found = {}
    for row in rows:
        if str(row.get("source_index", "")).isdigit() and (key := int(row["source_index"])) in wanted:
            found[key] = json.dumps({k: v for k, v in row.items() if k != "source_index"}, sort_keys=True)
    return found, 1


def one_pass(texts: DataFrame, backend: Backend, size: int) -> DataFrame:
    """(record_id, answer, calls) of the records that a pass with batches of ``size`` answers."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            records = frame.to_dict("records")
            for at in range(0, len(records), size):
                found, calls = answers(backend, records[at : at + size])
                if found:
                    yield pd.DataFrame({"record_id": list(found), "answer": list(found.values()), "calls": calls})

    return texts.select("record_id", "text").mapInPandas(run, SCHEMA)


def extract_in_passes(texts: DataFrame, backend: Backend, sizes: tuple[int, ...] = (10, 4, 1)) -> DataFrame:
    """(record_id, pass, answer): each record's first answer; those without one have pass 0 and a note.

    Every pass is written before the next one reads what is open, so no call is made twice.
    """
    open_, parts = texts, []
    for i, size in enumerate(sizes, 1):
        got = written(one_pass(open_, backend, size).select("record_id", F.lit(i).alias("pass"), "answer"), f"pass-{i}")
        parts.append(got)
        open_ = open_.join(got.select(F.col("record_id").alias("_done")), F.col("record_id") == F.col("_done"), "left_anti")
    out = open_.select("record_id", F.lit(0).alias("pass"), F.lit('{"note": "no answer"}').alias("answer"))
    for part in parts:
        out = part.unionByName(out)
    return out
