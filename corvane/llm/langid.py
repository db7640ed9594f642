"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds its
letters' vectors, each permuted by its place, by multiplication; a text's vector
bundles those of its trigrams by addition, and so does a language's prototype
over all texts to learn from. A text gets the language whose prototype has the
greatest cosine with its vector.

Bundling is linear, so a text's vector is its trigram counts times the trigram
vectors: texts are counted in Arrow batches and bundled by a matrix product.

Edge cases: a null text, and one without any letter, is ``und`` with score 0, and
so is every text when nothing can be learnt. A null language is not learnt from,
nor is a row with a null id. Letters outside the alphabet share hashed places.
A tie goes to the language that sorts first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import append_columns, col, fresh, held_out, learnable, map_rows, small_slices, texts

DIMENSIONS = 1024
SEED = 20
#: Symbols: 0 for whatever isn't a letter, 1-26 for a-z, then accented Latin letters, then hashed places for all others.
SYMBOLS, BITS = 512, 9
_ACCENTED = "àâäáãåæçèéêëìíîïñòóôöõøùúûüýÿßœ"
#: Texts that are bundled at a time.
ROWS = 256
#: Pairs of trigrams and counts that a task holds for a language before it adds them up.
PENDING = 1 << 20


def _symbols() -> np.ndarray:
    """Symbol of every code point of the basic plane; others are hashed as they come."""
    table = np.zeros(0x10000, dtype=np.uint16)
    hashed = 27 + len(_ACCENTED)
    for point in range(0x10000):
        low = chr(point).lower()
        if len(low) == 1 and "a" <= low <= "z":
            table[point] = ord(low) - 96
        elif low in _ACCENTED and len(low) == 1:
            table[point] = 27 + _ACCENTED.index(low)
        elif chr(point).isalpha():
            table[point] = hashed + zlib.crc32(low.encode("utf-8", "surrogatepass")) % (SYMBOLS - hashed)
    return table


_TABLE: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """Symbols of a text; every run of anything but letters is one 0, and a 0 stands at both ends."""
    if not _TABLE:
        _TABLE.append(_symbols())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if len(points) and points.max() >= 0x10000:
        wide = points >= 0x10000
        out = _TABLE[0][np.where(wide, 0, points)]
        letter = np.array([chr(x).isalpha() for x in points[wide].tolist()])
        out[wide] = np.where(letter, 27 + len(_ACCENTED) + points[wide] % (SYMBOLS - 27 - len(_ACCENTED)), 0)
    else:
        out = _TABLE[0][points]
    out = np.concatenate([[0], out, [0]]).astype(np.int32)
    return out[np.r_[True, (out[1:] != 0) | (out[:-1] != 0)]]


def trigrams(text: str) -> np.ndarray:
    """Codes of a text's trigrams, in order."""
    s = symbols(text)
    return s[:-2] << 2 * BITS | s[1:-1] << BITS | s[2:]


def letter_vectors() -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), size=(SYMBOLS, DIMENSIONS))


def gram_vectors(codes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Bound vectors of trigrams: the first letter's permuted twice, the second's once."""
    twice, once = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    return twice[codes >> 2 * BITS] * once[codes >> BITS & SYMBOLS - 1] * letters[codes & SYMBOLS - 1]


def bundled(counts: list[tuple[np.ndarray, np.ndarray]], letters: np.ndarray) -> np.ndarray:
    """Vectors of several texts from their (trigram codes, counts)."""
    used = np.unique(np.concatenate([c for c, _ in counts])) if counts else np.zeros(0, dtype=np.int64)
    dense = np.zeros((len(counts), len(used)), dtype=np.float32)
    for i, (codes, n) in enumerate(counts):
        dense[i, np.searchsorted(used, codes)] = n
    return dense @ gram_vectors(used, letters).astype(np.float32)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's trigram codes, ascending, and how often each occurs."""
    own = symbols(text)
    used = np.flatnonzero(np.bincount(own, minlength=1))
    if len(own) < 512 or len(used) > 100:
        return np.unique(own[:-2] << 2 * BITS | own[1:-1] << BITS | own[2:], return_counts=True)
    # A long text of few symbols is counted in a table of its own alphabet.
    place = np.zeros(SYMBOLS, dtype=np.int32)
    place[used] = np.arange(len(used))
    own, k = place[own], len(used)
    n = np.bincount((own[:-2] * k + own[1:-1]) * k + own[2:], minlength=1)
    at = np.flatnonzero(n)
    return used[at // (k * k)] << 2 * BITS | used[at // k % k] << BITS | used[at % k], n[at]


def _text(raw: bytes | None) -> str | None:
    text = raw.decode() if raw else None
    return text if text and any(map(str.isalpha, text)) else None


def prototypes(docs: DataFrame, text_col: str, lang_col: str) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their unit prototypes, over all rows given.

    Each task sums its texts' trigram counts by language, so what is shuffled and
    collected is bounded by languages times distinct trigrams.
    """
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("code", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        total: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held: dict[str, int] = {}

        def add(lang: str) -> None:
            codes, of = np.unique(np.concatenate([c for c, _ in total[lang]]), return_inverse=True)
            total[lang] = [(codes, np.bincount(of, weights=np.concatenate([n for _, n in total[lang]])).astype(np.int64))]
            held[lang] = 0

        for whole in batches:
            for batch in small_slices(whole, 1):
                for lang, raw in zip(batch.column(0).to_pylist(), texts(batch, 1)):
                    if (text := _text(raw)) is not None:
                        got = counted(text)
                        total.setdefault(lang, []).append(got)
                        held[lang] = held.get(lang, 0) + len(got[0])
                        if held[lang] > PENDING:
                            add(lang)
        for lang in total:
            add(lang)
            codes, n = total[lang][0]
            yield [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int32)), pa.array(n)]

    rows = map_rows(docs.select(col(lang_col).cast("string"), col(text_col)).where(col(lang_col).isNotNull()), run, schema)
    found = rows.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    if not langs:
        return [], np.zeros((0, DIMENSIONS), dtype=np.float32)
    lang, code, n = np.array(found["lang"].to_pylist()), found["code"].to_numpy().astype(np.int64), found["n"].to_numpy()
    counts = []
    for x in langs:
        own = lang == x
        order = np.argsort(code[own])
        counts.append((code[own][order], n[own][order]))
    vectors = bundled(counts, letter_vectors()).astype(np.float64)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return langs, (vectors / np.where(norm > 0, norm, 1)).astype(np.float32)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with the predicted language and its cosine (0 where negative), and those columns' names."""
    names = fresh(docs, "lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        langs, protos = sent.value
        letters = letter_vectors()

        def run(batch: list[bytes | None]) -> list[pa.Array]:
            pred, score = ["und"] * len(batch), [0.0] * len(batch)
            if not langs:
                return [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
            for start in range(0, len(batch), ROWS):
                at, counts = [], []
                for i in range(start, min(start + ROWS, len(batch))):
                    if (text := _text(batch[i])) is not None:
                        at.append(i)
                        counts.append(counted(text))
                if not at:
                    continue
                vectors = bundled(counts, letters)
                norm = np.linalg.norm(vectors, axis=1)
                cosine = vectors @ protos.T / np.where(norm > 0, norm, 1)[:, None]
                best = cosine.argmax(axis=1)
                for i, b, c in zip(at, best.tolist(), cosine.max(axis=1).tolist()):
                    pred[i], score[i] = langs[b], min(max(float(c), 0.0), 1.0)
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64())]

        return run

    return append_columns(docs, text_col, [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())], make), names


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Prototypes from all rows that may be learnt from."""
    return prototypes(docs.where(learnable(id_col)), text_col, lang_col)


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    out, (lang, score) = identify(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), col(lang).alias("lang_pred"), col(score).alias("score"))
