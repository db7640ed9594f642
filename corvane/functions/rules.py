"""Ordered rule tables, compiled to native expressions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Letters of a pattern's literal beginnings that a match is looked for by.
_LETTERS = 4


def _parts(pattern: str) -> Iterator[str]:
    """Alternatives of a pattern, those inside its groups left together."""
    depth, start, at = 0, 0, 0
    while at < len(pattern):
        sign = pattern[at]
        if sign == "\\":
            at += 1
        elif sign == "[":
            at = pattern.index("]", at + 2)
        elif sign == "|" and depth == 0:
            yield pattern[start:at]
            start = at + 1
        depth += (sign == "(") - (sign == ")")
        at += 1
    yield pattern[start:]


def heads(pattern: str) -> list[str] | None:
    """Lower-case texts, with one of which whatever the pattern matches in any case begins; None if that can't be said."""
    out: list[str] = []
    for part in _parts(pattern):
        while part.startswith(r"\b"):
            part = part[2:]
        if part.startswith("(") and (part[1:2] != "?" or part.startswith("(?:")):
            end = next(i for i in range(1, len(part)) if part[i] == ")" and len(list(_parts(part[: i + 1] + "|"))) == 2)
            inner = None if part[end + 1 : end + 2] in ("?", "*", "{") else heads(part[3 if part[1] == "?" else 1 : end])
            if inner is None:
                return None
            out += inner
            continue
        n = next((i for i, x in enumerate(part) if not (x.isascii() and x.isalnum()) and x != " "), len(part))
        n -= part[n : n + 1] in ("?", "*", "{")
        if n < 1:
            return None
        out.append(part[:n].lower())
    return out


def _any_of(texts: set[str]) -> str:
    """A pattern of the beginnings of texts, a letter at a time, so that few are tried."""
    if "" in texts:
        return ""
    rest: dict[str, set[str]] = {}
    for x in sorted(texts):
        rest.setdefault(x[0], set()).add(x[1:])
    return "(?:" + "|".join(x + _any_of(more) for x, more in rest.items()) + ")" if len(rest) > 1 else "".join(x + _any_of(more) for x, more in rest.items())


def at(start: str, pattern: str) -> str:
    """The pattern, tried only where ``start`` holds, which takes up no characters."""
    return f"{start}(?:{pattern})"


@lru_cache(maxsize=None)
def quick(pattern: str) -> str:
    """A pattern with the same matches in any case, tried only where the first letters of one of its alternatives stand."""
    found = heads(pattern)
    if found is None:
        return pattern
    words = r"\b" if all(x.startswith(r"\b") for x in _parts(pattern)) else ""
    first = "".join(sorted({x[0] for x in found}))  # one look at a set of letters spares the branches most of the time
    return at(f"{words}(?=[{first}])(?={_any_of({x[:_LETTERS] for x in found})})", pattern)


def beginnings(c: Column) -> Column:
    """The first letters of a text's words, in lower case: what ``may_hold`` looks in."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(rf"(?<![a-z0-9_])[a-z]{{{_LETTERS}}}"), F.lit(0)))


def may_hold(c: Column, words: Column | None, pattern: str) -> Column | None:
    """False only where the text, with these beginnings of words, can't hold a match; None if that can't be said."""
    texts = heads(pattern)
    if words is None or texts is None or not all(x.startswith(r"\b") for x in _parts(pattern)):
        return None
    long = sorted({x[:_LETTERS] for x in texts if x[:_LETTERS].isalpha() and len(x) >= _LETTERS})
    short = sorted({x for x in texts if x[:_LETTERS] not in long})
    low = F.lower(c)
    return reduce(or_, [F.arrays_overlap(words, F.array(*map(F.lit, long))), *(low.contains(x) for x in short)])


def first_match(c: Column, rules: Sequence[tuple[str, str]], default: str | None = "", lowered: Column | None = None) -> Column:
    """Label of the first rule whose pattern is found, in any case; the text in lower case, if given, saves most of the search."""
    out = F.lit(default)
    for pattern, label in reversed(rules):
        holds = c.rlike(f"(?i){pattern}")
        if lowered is not None and (texts := heads(pattern)):
            holds = reduce(or_, (lowered.contains(x) for x in texts)) & holds
        out = F.when(holds, F.lit(label)).otherwise(out)
    return out


def all_matches(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Labels of all rules whose pattern is found, in the rules' order."""
    return F.array_compact(F.array(*(F.when(c.rlike(f"(?i){p}"), F.lit(label)) for p, label in rules)))


def found(c: Column, pattern: str, group: int = 0, flags: str = "(?i)", words: Column | None = None) -> Column:
    """All matches of a pattern, or of one of its groups, in order; with the ``beginnings`` of the text, it is searched where it may hold some."""
    held = may_hold(c, words, pattern)
    if held is None:
        return F.regexp_extract_all(c, F.lit(flags + pattern), F.lit(group))
    return F.when(held | c.isNull(), F.regexp_extract_all(c, F.lit(flags + quick(pattern)), F.lit(group))).otherwise(F.array().cast("array<string>"))


def count(c: Column, pattern: str, words: Column | None = None) -> Column:
    held = may_hold(c, words, pattern)
    if held is None:
        return F.regexp_count(c, F.lit("(?i)" + pattern))
    return F.when(held | c.isNull(), F.regexp_count(c, F.lit("(?i)" + quick(pattern)))).otherwise(0)


def first(c: Column, pattern: str, group: int = 0, flags: str = "(?i)") -> Column:
    """The first match, or null."""
    return F.nullif(F.regexp_extract(c, flags + pattern, group), F.lit(""))
