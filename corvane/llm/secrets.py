"""Secret scan: fixed patterns, then dictionary-primed zstandard novelty.

Three patterns always report: assignments of long values to names such as
``password``, access keys, and long runs of hexadecimal digits. Beyond them every
long token in a sensitive context (a name such as ``key`` or ``bearer`` shortly
before it) is a candidate.

A candidate's marginal bytes are those that it adds to what a compressor, primed
with a dictionary of words and identifiers, makes of some code. Words match the
dictionary, random characters match nothing. How many bytes random characters
take depends on their alphabet and number, so the candidate is held against
shuffles of its own characters: its novelty is its marginal bytes over the mean of
theirs. A random string is as hard to compress as its shuffles, an identifier is
much easier. Humps, cases and separators are folded first, so that
``userSessionKey`` and ``USER_SESSION_KEY`` show the same words. What passes is
measured once more against the code around it, other occurrences of the candidate
taken out, and reported if it is still novel. Runs that any order compresses,
such as one repeated character, are not.

Offsets are code points, ends exclusive. Spans of one kind never overlap.

Edge cases: a null or empty text has no spans. A candidate that a base span
covers in part or whole is not reported again. Repeated rows get the same spans.
A candidate may have any length; none is cut.
"""

from __future__ import annotations

import bisect
import json
import random
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import append_columns, col, fresh
from corvane.llm.packing import vocabulary_path

KINDS = ("assign", "access", "hex", "novel")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
#: Characters of a candidate, at least; shorter strings of random characters can't be told from words by their bytes.
MIN_NOVEL = 16
#: Marginal bytes, as a share of those of the candidate's shuffles, from which it is reported.
MIN_NOVELTY = 0.92
#: Marginal bytes for each character below which a candidate is a pattern whatever its order.
MIN_BYTES = 0.4
#: Shuffles that a candidate is held against; one will do where it has many characters.
SHUFFLES, MANY = 6, 4096
#: Characters before a candidate in which a sensitive name counts, and on each side of it that prime the compressor.
CONTEXT, AROUND = 40, 2000
#: Words of the vocabulary in the dictionary, the most frequent ones with five letters or more.
WORDS = 12_000
LEVEL = 19

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
_CUE = re.compile(r"passwo?r?d|passphrase|pwd|secret|token|key|credential|bearer|auth|private|signature|session|cookie", re.IGNORECASE | re.ASCII)
_CUES = (b"passw", b"passp", b"pwd", b"secret", b"token", b"key", b"credential", b"bearer", b"auth", b"private", b"signature", b"session", b"cookie")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_NOVEL)
_TOKEN_START, _TOKEN_END = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"[A-Za-z0-9+/_-]+\Z")
#: Words of an identifier: humps, runs of capitals, digits.
_HUMP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: Words that source code and settings are full of.
_CODE = (
    "if else for while return def class import from public static void int string new this self null none true false function var let const async await try catch except raise throw "
    "get set add remove update delete create find load save read write open close start stop init build make parse format validate check test run handle process send receive connect "
    "user name id key value type size count index list map array item node data file path dir url host port server client request response session token secret password auth login "
    "account config setting option param arg env default error message status code state event time date end min max first last next previous parent child root base main app service "
    "manager factory builder provider handler controller model view table column row field record query result cache buffer stream input output source target context version"
).split()
_RUNS = "abcdefghijklmnopqrstuvwxyz 0123456789 qwertyuiop asdfghjkl zxcvbnm"


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns; the whole match is the span."""
    out = []
    low = raw.lower()
    if b"passw" in low or b"secret" in low or b"token" in low or b"apikey" in low or b"api_key" in low:
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if b"AKIA" in raw:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return out


def folded(text: str) -> str:
    """The words of identifiers, lower-case, with one separator between them."""
    return "_".join(_HUMP.findall(text)).lower()


class Novelty:
    """Marginal compressed bytes against a dictionary of the vocabulary's words and some code made of them."""

    def __init__(self, vocabulary: str | None = None) -> None:
        with open(vocabulary or vocabulary_path(), encoding="utf-8") as file:
            entries = json.load(file)["model"]["vocab"]
        words = [w[:-4] for w in entries if w.endswith("</w>")]
        words = [w for w in words if w.isascii() and w.isalpha()]
        rng = random.Random(5)
        common = [w for w in words if len(w) > 2][:3000]
        # The nearer a word stands to the end, the shorter is a reference to it.
        known = " ".join([*reversed([w for w in words if len(w) > 4][:WORDS]), _RUNS, *_CODE])
        lines = [f"{'_'.join(rng.sample(_CODE, 2))} = {'_'.join(rng.sample(common, 2))}({rng.choice(_CODE)}, {rng.randrange(100)}) {rng.choice(words)}" for _ in range(60)]
        self._code = "\n".join(lines) + "\n"
        held = zstandard.ZstdCompressionDict(known.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        self._press = zstandard.ZstdCompressor(dict_data=held, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        self._alone = lru_cache(maxsize=20_000)(lambda token: self.measure(token, ""))

    def measure(self, token: str, around: str) -> float:
        """Marginal bytes of ``token`` after ``around``, over those of its shuffles; 0 where any order compresses."""
        token = folded(token)
        start = (self._code + around).encode()
        plain = len(self._press.compress(start))

        def cost(x: str) -> int:
            return len(self._press.compress(start + x.encode())) - plain

        own = cost(token)
        if own < MIN_BYTES * len(token):
            return 0.0
        if len(token) > MANY:
            letters = np.frombuffer(token.encode(), dtype=np.uint8)
            others = [np.random.default_rng(len(token)).permutation(letters).tobytes().decode()]
        else:
            rng = random.Random(token)
            others = ["".join(rng.sample(token, len(token))) for _ in range(SHUFFLES)]
        return own / max(sum(map(cost, others)) / len(others), 1)

    def passes(self, token: str, before: str, after: str) -> bool:
        """Whether a candidate is novel by itself and after the code around it."""
        return self._alone(token) >= MIN_NOVELTY and self.measure(token, folded(after) + "\n" + folded(before) + "\n") >= MIN_NOVELTY


@lru_cache(maxsize=1)
def _novelty() -> Novelty:
    return Novelty()


def surroundings(text: str, start: int, end: int) -> tuple[str, str]:
    """The text before and after a candidate without other occurrences of it."""
    before, after, token = text[max(0, start - AROUND) : start], text[end : end + AROUND], text[start:end]
    before, after = before.replace(token, " "), after.replace(token, " ")
    # A copy that the edge cuts is taken out with the token it belongs to.
    if start > AROUND and (cut := _TOKEN_START.match(before)) and cut.end() >= MIN_NOVEL // 2:
        before = before[cut.end() :]
    if end + AROUND < len(text) and (cut := _TOKEN_END.search(after, max(0, len(after) - AROUND))) and len(cut[0]) >= MIN_NOVEL // 2:
        after = after[: cut.start()]
    return before, after


def novel_spans(text: str, raw: bytes, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Incompressible tokens in sensitive context that no base span touches."""
    low = raw.lower()
    if not any(x in low for x in _CUES):
        return []
    starts: list[int] = []
    reach: list[int] = []  # the furthest end of the base spans up to here
    for s, e, _ in sorted(taken):
        starts.append(s)
        reach.append(max(e, reach[-1]) if reach else e)
    out = []
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        k = bisect.bisect_left(starts, end)
        if k and reach[k - 1] > start:
            continue
        if not _HUMP.search(m[0]) or not _CUE.search(text, max(0, start - CONTEXT), start):
            continue
        if _novelty().passes(m[0], *surroundings(text, start, end)):
            out.append((start, end, "novel"))
    return out


def scan(raw: bytes | None) -> list[tuple[int, int, str]]:
    """All spans of a text, by start and then by kind as listed."""
    if not raw:
        return []
    text = raw.decode()
    found = base_spans(text, raw)
    found += novel_spans(text, raw, found)
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def find_secrets(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with their spans as an array of (start, end, kind), and that column's name."""
    (name,) = fresh(docs, "secrets")

    def make():
        return lambda batch: [pa.array([[dict(zip(("start", "end", "kind"), s)) for s in scan(x)] for x in batch], _ARROW_SPANS)]

    return append_columns(docs, text_col, [T.StructField(name, _SPANS)], make), name


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found, s = find_secrets(docs.select("doc_id", "text"))

    def text_of(which):
        return F.array_join(F.transform(which, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of_kind(k):
        return F.filter(col(s), lambda x: x["kind"] == k)

    base = F.filter(col(s), lambda x: x["kind"] != "novel")
    return found.select(
        "doc_id",
        *(F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of(col(s)).alias("spans"),
    )
