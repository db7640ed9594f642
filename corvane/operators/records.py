"""Record splitters and section segmentation over raw corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import tables

#: More parts than an array can hold, with room for the start to be added.
_REST = 1 << 30
_START, _END = "\u0001", "\u0002"
_LABELS = "|".join(f"(?:{p})" for p, _ in tables.SECTIONS)


def _kept(parts: Column) -> Column:
    """Parts without white space around them, and without empty ones."""
    return F.filter(F.transform(parts, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")


def split_numbered(text: Column) -> Column:
    """Records that begin with ``n. `` on the first line or after a blank one."""
    lines = F.regexp_replace(text, r"\r\n?", "\n")
    marked = F.regexp_replace(lines, r"(\A|\n[ \t]*\n)(?=\d+\.[ \t]+\S)", "$1" + _START)
    return _kept(F.slice(F.split(marked, _START), 2, _REST))


def split_marked(text: Column) -> Column:
    """Records between lines of ``=`` if two of them begin ``[n] ``; else those that begin with ``n. `` or ``[n] ``, if
    there are two; else the parts after a blank line that begin with a capitalised line."""
    whole = F.trim(F.regexp_replace(text, r"\r\n?", "\n"))

    ruled = F.filter(_kept(F.split(whole, r"(?m)^\s*=+\s*$")), lambda x: x.rlike(r"^\[\d+\]\s"))
    numbered = _kept(F.slice(F.split(F.regexp_replace(whole, r"(?m)^(?=(?:\d+\.\s|\[\d+\]\s))", _START), _START), 2, _REST))
    loose = _kept(F.split(whole, r"\n\s*\n(?=[A-Z][^\n]{10,200}\n)"))
    return F.when(F.size(ruled) >= 2, ruled).when(F.size(numbered) >= 2, numbered).otherwise(loose)


def sections(text: Column) -> Column:
    """(label, content) of each labelled section, in order; what stands before the first label is ``BACKGROUND``."""
    marked = F.regexp_replace(text, rf"(?i)\b({_LABELS})\s*:[ \t]*", f"{_START}$1{_END}")
    parts = F.split(marked, _START)
    lead = F.trim(F.element_at(parts, 1))
    found = F.transform(
        F.slice(parts, 2, _REST),
        lambda x: F.struct(F.upper(F.trim(F.split_part(x, F.lit(_END), F.lit(1)))).alias("label"), F.trim(F.split_part(x, F.lit(_END), F.lit(2))).alias("content")),
    )
    first = F.filter(F.array(F.struct(F.lit("BACKGROUND").alias("label"), lead.alias("content"))), lambda x: x["content"] != "")
    return F.when(F.size(found) > 0, F.concat(first, found)).otherwise(F.slice(found, 1, 0))


def section_key(label: Column) -> Column:
    out = F.lit("")
    for pattern, key in reversed(tables.SECTIONS):
        out = F.when(label.rlike(f"(?i)^(?:{pattern})$"), key).otherwise(out)
    return out


def segment(df: DataFrame, id_col: str, text: Column) -> DataFrame:
    """(id, section, content): repeated sections of a record are joined by a space, in order."""
    rows = df.select(id_col, F.posexplode(sections(text)).alias("at", "s")).select(id_col, "at", section_key(F.col("s.label")).alias("section"), "s.content")
    grouped = rows.where("section != ''").groupBy(id_col, "section").agg(F.array_sort(F.collect_list(F.struct("at", "content"))).alias("parts"))
    return grouped.select(id_col, "section", F.trim(F.array_join(F.transform("parts", lambda x: x["content"]), " ")).alias("content"))


def explode_records(df: DataFrame, records: Column) -> DataFrame:
    """(record_id from 1, record)."""
    return df.select(F.posexplode(records).alias("at", "record")).select((F.col("at") + 1).alias("record_id"), "record")
