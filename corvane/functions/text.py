"""Text cleaning as native column expressions. Null counts as the empty text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(c: Column) -> Column:
    """Runs of white space, Unicode's included, become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def plain_signs(c: Column) -> Column:
    """``clean`` with dashes and the plus-minus sign in ASCII."""
    out = clean(c)
    for sign, ascii_ in (("–", "-"), ("—", "-"), ("−", "-"), ("±", "+/-")):
        out = F.replace(out, F.lit(sign), F.lit(ascii_))
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def dedupe_by(items: Column, key: Callable[[Column], Column]) -> Column:
    """Items whose ``key`` differs from that of every earlier one, in order."""

    def kept(pairs: Column) -> Column:
        first = let(pairs["key"], lambda keys: F.filter(pairs, lambda x, i: F.array_position(keys, x["key"]) == i + 1))
        return F.transform(first, lambda x: x["item"])

    def of(found: Column) -> Column:
        pairs = F.transform(found, lambda x: F.struct(key(x).alias("key"), x.alias("item")))
        return F.when(F.size(found) < 2, found).otherwise(let(pairs, kept))

    return let(items, of)


def ordered_dedupe(items: Column) -> Column:
    """Items cleaned, without empty ones, and without those equal to an earlier one but for case."""
    return dedupe_by(F.filter(F.transform(items, clean), lambda x: x != ""), F.lower)


def clip(c: Column, limit: int) -> Column:
    """At most ``limit`` characters, the last three of them dots where something was cut."""
    head = F.regexp_replace(F.substring(c, 1, limit - 3), r"[ ,;:-]+$", "")
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(head, F.lit("...")))


def merge_labels(items: Column, limit: int = 120) -> Column:
    return clip(F.array_join(ordered_dedupe(items), " || "), limit)


def fragments(c: Column) -> Column:
    """Parts between ``||`` or ``;``, cleaned and without repeats."""
    return ordered_dedupe(F.split(clean(c), r"\s*\|\|\s*|;"))


def ascii_key(c: Column) -> Column:
    """Lower-case ASCII letters and digits alone."""
    return F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "")


def alnum_key(c: Column) -> Column:
    """Lower-case letters and digits of any script."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", "")


def token_estimate(c: Column) -> Column:
    """A token for every four characters, one at least."""
    return F.greatest(F.lit(1), F.ceil(F.length(F.coalesce(c, F.lit(""))) / 4)).cast("long")


def bracketed(codes: Column) -> Column:
    """No code: empty; one: itself; more: ``[a,b]``, without repeats and in order."""
    unique = F.array_distinct(codes)
    texts = F.transform(unique, lambda x: x.cast("string"))
    return (
        F.when(F.size(unique) == 0, "").when(F.size(unique) == 1, F.element_at(texts, 1)).otherwise(F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")))
    )


def number(c: Column) -> Column:
    """The number a text stands for, thousands commas aside; null if it is none."""
    return F.replace(F.coalesce(c, F.lit("")), F.lit(","), F.lit("")).try_cast("double")

