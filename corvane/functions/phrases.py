"""Rules over phrases for what column expressions can't say: matches with their places, vetoes by the words around
them, rewriting in turn, and folds that look back at what was kept.

Rule files are plain rows in ``corvane/rules``: a pattern, and what it stands for.
They are tried in the file's order, in any case. The functions here are plain
Python over one text; ``column`` lifts them to Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER = Path(__file__).resolve().parent.parent / "rules"
_NAME = re.compile(r"<<(\w+)>>")
_SLOT = re.compile(r"\{(\d)(:title)?\}")


@lru_cache(maxsize=None)
def rows(name: str) -> tuple[tuple[str, ...], ...]:
    """The rows of a rule file."""
    lines = (FOLDER / f"{name}.tsv").read_text(encoding="utf-8").split("\n")
    return tuple(tuple(x.split("\t")) for x in lines if x and not x.startswith("# "))


@lru_cache(maxsize=None)
def named(name: str) -> dict[str, str]:
    """A file of named patterns, each of which may hold earlier ones."""
    out: dict[str, str] = {}
    for key, pattern in rows(name):
        out[key] = expand(pattern, out)
    return out


def expand(pattern: str, names: dict[str, str]) -> str:
    return _NAME.sub(lambda m: names[m[1]], pattern)


def compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.IGNORECASE)


def squeeze(text: object) -> str:
    """Runs of white space become one space; nothing gives the empty text."""
    return " ".join(str(text or "").split())


def distinct(items: Iterable[str], clean: Callable[[str], str] = squeeze) -> list[str]:
    """Items cleaned, without empty ones and later ones that differ in case alone."""
    found: dict[str, str] = {}
    for item in map(clean, items):
        if item:
            found.setdefault(item.lower(), item)
    return list(found.values())


def clip(text: str, limit: int, trailing: str = " ") -> str:
    """At most ``limit`` characters, dots for what was cut."""
    return text if len(text) <= limit else text[: limit - 3].rstrip(trailing) + "..."


def render(template: str, m: re.Match) -> str:
    """A template with the groups of a match in its slots."""
    return _SLOT.sub(lambda s: (m[int(s[1])] or "").title() if s[2] else (m[int(s[1])] or ""), template)


Guard = Callable[[str, re.Match], bool]


class Rules:
    """Ordered rules: patterns, and templates of what they stand for."""

    def __init__(self, name: str, names: dict[str, str] | None = None) -> None:
        self.rules = [(compiled(expand(r[0], names or {})), r[1] if len(r) > 1 else "") for r in rows(name)]

    def hits(self, text: str, allowed: Guard | None = None) -> Iterator[tuple[re.Match, str]]:
        """Matches in the rules' order, then by place, each with what it stands for."""
        for pattern, template in self.rules:
            for m in pattern.finditer(text):
                if allowed is None or allowed(text, m):
                    yield m, render(template, m)

    def first(self, text: str, allowed: Guard | None = None) -> str:
        return next((label for _, label in self.hits(text, allowed) if label), "")

    def every(self, text: str) -> list[str]:
        return distinct(label for _, label in self.hits(text))

    def which(self, text: str) -> list[str]:
        """What the rules that match stand for, once each."""
        return [template for pattern, template in self.rules if pattern.search(text)]

    def any(self, text: str) -> bool:
        return any(pattern.search(text) for pattern, _ in self.rules)

    def rewrite(self, text: str) -> str:
        for pattern, template in self.rules:
            text = pattern.sub(lambda m, t=template: render(t, m), text)
        return text


def window(text: str, m: re.Match, before: int, after: int) -> str:
    """What stands around a match, itself included."""
    return text[max(0, m.start() - before) : m.end() + after]


def column(function: Callable, kind: str | T.DataType) -> Callable[..., Column]:
    """A function of texts as a function of columns, in Arrow batches; null counts as the empty text."""

    def run(*values):
        return function(*("" if v is None else v for v in values))

    run.__name__ = function.__name__
    return F.udf(run, kind, useArrow=True)


def structure(names: Iterable[str], kinds: dict[str, T.DataType] | None = None) -> T.StructType:
    return T.StructType([T.StructField(n, (kinds or {}).get(n, T.StringType())) for n in names])
