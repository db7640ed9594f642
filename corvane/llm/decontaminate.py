"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items form one automaton over words. Every document streams
through it; at each word the length of the longest suffix that is a substring of
some item is known, so every occurrence of an item window ends where that length
reaches the window. Spans that reach the length limit are removed, and documents
with a larger covered share than the coverage limit go altogether.

Edge cases: a null or empty text, and one without words, has no words and no
hits. A null item text, or one without words, contributes no window. Items that
share an id count once. A null item id is reported as the text ``null``.
Repeated rows are independent. An empty item table hits nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import append_columns, col, fresh, map_rows

WINDOW = 10
#: Words of test items in one automaton; further items form further automata, each with a pass of its own.
BLOCK_WORDS = 200_000

_WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
#: A-Z become a-z, and every byte outside words becomes a space.
_FOLD = bytes(c if c in _WORD_BYTES else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and anything beyond ASCII."""
    return text.translate(_FOLD).split() if text else []


class Automaton:
    """Generalised suffix automaton over the words of several items."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.vocabulary: dict[bytes, int] = {}
        self.whole: dict[int, dict[int, set[str]]] = {}
        self.holders: dict[int, set[str]] = {}
        self.known: dict[int, list[tuple[int, set[str]]]] = {}
        todo = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for name, ws in items if ws]
        for _, ids in todo:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        for name, ids in todo:
            self._mark(name, ids)
        self.least = min([window, *(len(ids) for _, ids in todo)])

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def _mark(self, name: str, ids: list[int]) -> None:
        """Note the item at every state that holds one of its windows."""
        v = 0
        for c in ids:
            v = self.next[v][c]
            u = v
            while self.length[u] >= self.window:
                held = self.holders.setdefault(u, set())
                if name in held:
                    break
                held.add(name)
                u = self.link[u]
        if len(ids) < self.window:
            self.whole.setdefault(v, {}).setdefault(len(ids), set()).add(name)

    def reports(self, state: int) -> list[tuple[int, set[str]]]:
        """(length, items) of the windows that end a match in ``state``, shortest first."""
        if (found := self.known.get(state)) is None:
            found, u = [], state
            while u > 0:
                if self.length[u] >= self.window > self.length[self.link[u]] and u in self.holders:
                    found.append((self.window, self.holders[u]))
                found += self.whole.get(u, {}).items()
                u = self.link[u]
            found = self.known[state] = sorted(found, key=lambda x: x[0])
        return found

    def scan(self, ws: list[bytes]) -> tuple[list[int], set[str]]:
        """Merged [start, end) word intervals that windows cover, flat; and the items found."""
        nxt, link, length, least = self.next, self.link, self.length, self.least
        spans: list[int] = []
        items: set[str] = set()
        state = matched = 0
        here = root = nxt[0]
        for i, c in enumerate(map(self.vocabulary.get, ws)):
            to = here.get(c)
            if to is None:
                if not matched:
                    continue
                while to is None and state:
                    state = link[state]
                    to = nxt[state].get(c)
                matched = length[state]
                if to is None:
                    here = root
                    continue
            matched += 1
            state = to
            here = nxt[to]
            if matched >= least:
                longest = 0
                for n, who in self.reports(to):
                    if n > matched:
                        break
                    longest = n
                    items |= who
                if longest:
                    start = i + 1 - longest
                    while spans and start <= spans[-1]:
                        start = min(start, spans[-2])
                        del spans[-2:]
                    spans += (start, i + 1)
        return spans, items


def merged(a: list[int], b: list[int]) -> list[int]:
    """Union of two flat lists of [start, end) intervals."""
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += (s, e)
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[list]:
    """(id, words) of the items, in blocks of bounded size.

    One block is with the driver at a time. An item beyond a block's size is cut
    into pieces that overlap by a window less one word, so that no window is lost.
    """
    block, held = [], 0
    for name, text in items.select(col(id_col).cast("string"), col(text_col)).toLocalIterator():
        ws = words(text.encode() if text else None)
        step = max(block_words, window)
        for at in range(0, max(len(ws) - window + 1, 1) if ws else 0, step):
            part = ws[at : at + step + window - 1] if len(ws) >= window else ws
            if held and held + len(part) > block_words:
                yield block
                block, held = [], 0
            block.append(("null" if name is None else name, part))
            held += len(part)
    yield block


_BUILT: dict[str, Automaton] = {}


def _automaton(key: str, items: list, window: int) -> Automaton:
    """The automaton of a block, built once in each Python worker."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(items, window)
    return _BUILT[key]


def match(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, list[str]]:
    """``docs`` with three columns more, and those columns' names.

    They hold the number of words, the covered word intervals (flat, merged,
    end exclusive), and the ids of the items found (sorted as text). The text is
    read once for each block of ``block_words`` item words; nothing is shuffled.
    """
    import uuid

    spark = docs.sparkSession
    names = fresh(docs, "n_words", "hit_spans", "item_ids")
    out, before = docs, 0
    for block in item_blocks(items, item_id_col, item_text_col, window, block_words):
        sent, key = spark.sparkContext.broadcast(block), uuid.uuid4().hex
        fields = [
            T.StructField(names[0] + "_" * before, T.LongType()),
            T.StructField(names[1] + "_" * before, T.ArrayType(T.IntegerType())),
            T.StructField(names[2] + "_" * before, T.ArrayType(T.StringType())),
        ]

        def make(sent=sent, key=key):
            automaton = _automaton(key, sent.value, window)

            def run(batch: list[bytes | None]) -> list[pa.Array]:
                n, spans, found = [], [], []
                for text in batch:
                    ws = words(text)
                    at, who = automaton.scan(ws)
                    n.append(len(ws))
                    spans.append(at)
                    found.append(sorted(who))
                return [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))]

            return run

        wider = fresh(out, *(f.name for f in fields))
        fields = [T.StructField(a, f.dataType) for a, f in zip(wider, fields)]
        got = append_columns(out, text_col, fields, make)
        if before:
            joint = F.udf(merged, T.ArrayType(T.IntegerType()), useArrow=True)
            got = got.select(
                *(col(c) for c in docs.columns),
                col(names[0]),
                joint(col(names[1]), col(wider[1])).alias(names[1]),
                F.array_sort(F.array_union(col(names[2]), col(wider[2]))).alias(names[2]),
            )
        out, before = got, 1
    return out, names


def without_spans(text: str, spans: list[int]) -> str:
    """``text`` without the words in ``spans`` and what stands between them; a space stays in each place."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    parts, last = [], 0
    for s, e in zip(spans[::2], spans[1::2]):
        parts.append(raw[last : at[s][0]])
        last = at[e - 1][1]
    parts.append(raw[last:])
    return b" ".join(parts).decode()


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without benchmark passages, with the same columns.

    Covered spans are cut out of the text. A document of which more than
    ``max_coverage`` of the words are covered goes. Others come back unchanged.
    """
    found, (n, spans, _) = match(docs, items, text_col, item_id_col, item_text_col, window, block_words)
    kept = found.where(n_covered(spans) <= F.lit(max_coverage) * col(n)).select(*(col(c) for c in docs.columns), col(spans))
    at, width = docs.columns.index(text_col), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            cuts = batch.column(width).to_pylist()
            if any(cuts):
                clean = [without_spans(x, c) if c else x for x, c in zip(batch.column(at).to_pylist(), cuts)]
                columns = [pa.array(clean, pa.string()) if k == at else batch.column(k) for k in range(width)]
            else:
                columns = batch.columns[:width]
            yield columns

    return map_rows(kept, run, docs.schema)


def n_covered(spans: str) -> Column:
    """Words inside a column of flat intervals."""
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(-1).cast("long").alias("sign"))
    return F.aggregate(col(spans), zero, lambda a, x: F.struct((a["total"] + a["sign"] * x).alias("total"), (-a["sign"]).alias("sign")))["total"]


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found, (n, spans, ids) = match(docs.select("doc_id", "text"), items)
    return found.select(
        "doc_id",
        col(n).alias("n_words"),
        n_covered(spans).alias("n_hit"),
        F.size(col(ids)).cast("long").alias("n_items"),
        F.sha2(F.array_join(col(ids), ","), 256).alias("items_sha256"),
        (F.size(col(spans)) > 0).alias("contaminated"),
    )
