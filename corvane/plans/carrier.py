"""Carrier texts: clinical sentences made from key columns, the same in Spark and in an SQL oracle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


class Pick:
    """One of several phrases, by a whole-number expression."""

    def __init__(self, key: str, phrases: Sequence[str]) -> None:
        self.key, self.phrases = key, phrases

    def column(self) -> Column:
        return F.element_at(F.array(*map(F.lit, self.phrases)), F.expr(f"cast(({self.key}) % {len(self.phrases)} as int) + 1"))

    def sql(self) -> str:
        return f"list_extract([{', '.join(map(quote, self.phrases))}], cast(({self.key}) % {len(self.phrases)} as int) + 1)"


class Number:
    """A whole-number expression as text."""

    def __init__(self, expression: str) -> None:
        self.expression = expression

    def column(self) -> Column:
        return F.expr(f"cast({self.expression} as string)")

    def sql(self) -> str:
        return f"cast({self.expression} as varchar)"


class Carrier:
    def __init__(self, *parts: str | Pick | Number) -> None:
        self.parts = parts

    def column(self) -> Column:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p.column() for p in self.parts))

    def sql(self) -> str:
        return "(" + " || ".join(quote(p) if isinstance(p, str) else p.sql() for p in self.parts) + ")"


# SQL for the oracles, from rule tables.


def case(text: str, rules: Sequence[tuple[str, object]], default: str) -> str:
    whens = " ".join(f"when regexp_matches({text}, {quote('(?i)' + p)}) then {quote(v) if isinstance(v, str) else v}" for p, v in rules)
    return f"(case {whens} else {default} end)"


def hits(text: str, rules: Sequence[tuple[str, object]]) -> str:
    items = ", ".join(f"case when regexp_matches({text}, {quote('(?i)' + p)}) then {quote(v) if isinstance(v, str) else v} end" for p, v in rules)
    return f"list_filter([{items}], lambda x: x is not null)"


def found(text: str, pattern: str, group: int = 0, flags: str = "(?i)") -> str:
    return f"regexp_extract_all({text}, {quote(flags + pattern)}, {group})"


def count(text: str, pattern: str) -> str:
    return f"len({found(text, pattern)})"


def first(text: str, pattern: str, group: int = 0, flags: str = "(?i)") -> str:
    return f"nullif(regexp_extract({text}, {quote(flags + pattern)}, {group}), '')"


def dedupe(items: str, key: str = "lower({})") -> str:
    x, y = key.format("x"), key.format("y")
    return f"list_filter({items}, lambda x, i: list_position(list_transform({items}, lambda y: {y}), {x}) = i)"


def joined(items: str, limit: int) -> str:
    return f"(case when len({items}) > 0 then array_to_string(({items})[1:{limit}], '; ') end)"
