"""Toxicity by multiple-instance learning.

A text is a bag of sentences, and a sentence a bag of features, which its words
have. A feature has a rate, zero for almost all; a sentence is toxic with the
noisy-or of its features, one minus exp of minus the sum of their rates, and a
text with the noisy-or of its sentences. The rates are trained through that
product from labels of whole texts alone, and then tell which sentences made a
text toxic. A sentence without a feature that has a rate adds nothing, so neutral
text of any length scores zero.

A word counts by its hash and by the hash of its first letters, so that an
inflected form that training never saw still resembles its stem. A sentence's
score rests on its set of words.

Edge cases: a null or empty text has no sentence and the score 0. Labels of null,
ids without a document and null ids are not learnt from. Without labels of both
classes every score is 0. A text without sentence marks is one sentence for each
line. Repeated rows get the same score. Ids may be of any type.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from heapq import nsmallest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import append_columns, col, discard, fresh, held_out, learnable, map_rows, small_slices, texts, written

THRESHOLD = 0.3
#: Labelled rows to learn from, at most, by class (0, 1): those whose ids hash lowest. Their weights restore the classes' shares.
SAMPLE = (4000, 2000)
#: Numbers for features: so many that a rare word hardly shares one with a frequent word.
BUCKETS = 1 << 24
#: First letters that make a word's stem.
STEM = 5
STEPS = 400
#: A feature needs so many different toxic sentences, copies counted once, and to be so many times as frequent in toxic texts as in clean ones.
#: Instead of different sentences there may be as many different texts around them, if half of its toxic texts differ: copies and near-copies hardly do.
MIN_SENTENCES, MIN_RATIO = 3, 6
#: Sentences without effect that every feature is taken to have been in, beside those that it was in.
PRIOR = 0.3
#: Rates below this are noise and become zero.
MIN_RATE = 0.1

#: ASCII letters and digits and whatever is beyond ASCII make words; '.', '!', '?' and line ends end sentences.
_FOLD = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 0x80 else c + 32 if 65 <= c <= 90 else 10 if c in b".!?\n" else 32 for c in range(256)
)
_SENTENCE = re.compile(r"[^.!?\n]+")


def sentences(text: bytes | None) -> list[list[bytes]]:
    """Words of each sentence that has one."""
    if not text:
        return []
    return [ws for x in text.translate(_FOLD).split(b"\n") if (ws := x.split())]


def buckets(word: bytes) -> tuple[int, int]:
    """Features of a word: itself, and its first letters."""
    digest = xxhash.xxh3_64_intdigest
    half = BUCKETS // 2
    return digest(word) % half, half + digest(word.decode("utf-8", "ignore")[:STEM].encode()) % half


class _Weighted(dict):
    """The features of a word that have a rate; each word is hashed once while it is remembered."""

    def __init__(self, rates: dict[int, float], size: int) -> None:
        super().__init__()
        self.rates, self.size = rates, size

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.size:
            self.clear()
        out = self[word] = tuple(x for x in buckets(word) if x in self.rates)
        return out


class Model:
    """Rates of features, and the noisy-or of what has them."""

    def __init__(self, rates: dict[int, float], size: int = 100_000) -> None:
        self.rates, self.size = rates, size
        self.known = _Weighted(rates, size)

    def __reduce__(self):
        return Model, (self.rates, self.size)

    def rate(self, ws: list[bytes]) -> float:
        """Sum of the rates of a sentence's features."""
        found = set().union(*filter(None, map(self.known.__getitem__, ws)))
        return float(sum(self.rates[x] for x in sorted(found))) if found else 0.0

    def sentence(self, ws: list[bytes]) -> float:
        """Probability that a sentence is toxic."""
        return float(-np.expm1(-self.rate(ws)))

    def score(self, text: bytes | None) -> float:
        return float(-np.expm1(-sum(map(self.rate, sentences(text)))))


def _sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, sizes: tuple[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """(row, hash of the id, label, text) of the labelled rows to learn from, and how many rows each class has in all."""
    rows = labels.select(col(id_col).alias("s_id"), col(label).cast("int").alias("s_label")).where(learnable("s_id")).where("s_label in (0, 1)")
    totals = {r["s_label"]: r["count"] for r in rows.groupBy("s_label").count().collect()}
    order = F.xxhash64(F.lit(9), "s_id")
    chosen = reduce(DataFrame.unionByName, [rows.where(F.col("s_label") == k).orderBy(order, "s_id").limit(sizes[k]) for k in (0, 1)])
    own = docs.select(col(id_col).alias("t_id"), col(text_col).alias("t_text"))
    # As many small rows as ``sizes`` say at most: this side is bounded whatever the corpus holds.
    found = own.join(F.broadcast(chosen), F.col("t_id") == F.col("s_id"))
    return found.select(F.monotonically_increasing_id(), F.xxhash64("s_id"), "s_label", "t_text"), totals


_COUNTS = T.StructType(
    [
        T.StructField("row", T.LongType(), False),
        T.StructField("id", T.LongType(), False),
        T.StructField("label", T.IntegerType(), False),
        T.StructField("feature", T.IntegerType(), False),
        #: Sentences of the text that have the feature, and the least hash of one.
        T.StructField("n", T.IntegerType(), False),
        T.StructField("least", T.LongType(), False),
        #: The least hash of a sentence of the text other than that one; -1 if there is none.
        T.StructField("around", T.LongType(), False),
    ]
)


def _counts(sample: DataFrame) -> DataFrame:
    """A row for each text of the sample, (row, id, label, text), and feature that it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        known: dict[bytes, tuple[int, int]] = {}
        for whole in batches:
            for batch in small_slices(whole, 3):
                of, at, n, least, around = [], [], [], [], []
                for k, text in enumerate(texts(batch, 3)):
                    found: dict[int, list[int]] = {}
                    digests = {-1}
                    for ws in sentences(text):
                        own = set(ws)
                        digest = xxhash.xxh3_64_intdigest(b" ".join(sorted(own))) >> 1
                        digests.add(digest)
                        if len(known) > 200_000:
                            known.clear()
                        for x in {x for w in own for x in (known.get(w) or known.setdefault(w, buckets(w)))}:
                            seen = found.setdefault(x, [0, digest])
                            seen[0] += 1
                            seen[1] = min(seen[1], digest)
                    of += [k] * len(found)
                    at += found
                    n += [x[0] for x in found.values()]
                    least += [x[1] for x in found.values()]
                    first, second = (nsmallest(3, digests)[1:] + [-1, -1])[:2]
                    around += [second if x[1] == first else first for x in found.values()]
                take = pa.array(of, pa.int64())
                yield [*(batch.column(i).take(take) for i in range(3)), pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(least, pa.int64()), pa.array(around, pa.int64())]

    return map_rows(sample, run, _COUNTS)


def fit(text_of: np.ndarray, label_of: np.ndarray, feature: np.ndarray, n: np.ndarray, weight: tuple[float, float] = (1.0, 1.0), steps: int = STEPS) -> dict[int, float]:
    """Rates of the features that have one, by expectation maximisation of the labels' likelihood.

    The rows say how many sentences ``n`` of the text numbered ``text_of`` have a
    ``feature``; ``label_of`` has the label of each text. A toxic text shares its
    toxicity among its features by their rates, a clean one has none to share, and
    a feature's next rate is its shares for each sentence that has it. ``weight``
    is what a text of each class counts for.
    """
    used, at = np.unique(feature, return_inverse=True)
    if not len(used):
        return {}
    own = np.array(weight)[label_of]
    toxic = np.where(label_of == 1, own, 0.0)
    exposed = np.bincount(at, weights=n * own[text_of]) + PRIOR
    rate = np.full(len(used), 0.2)
    for k in range(2 * steps):
        if k == steps:
            rate[rate < MIN_RATE] = 0
        left = np.bincount(text_of, weights=n * rate[at], minlength=len(label_of))
        share = toxic / np.maximum(-np.expm1(-left), 1e-9)
        rate = rate * np.bincount(at, weights=n * share[text_of]) / exposed
    return {f: r for f, r in zip(used.tolist(), rate.tolist()) if r >= MIN_RATE}


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sizes: tuple[int, int] = SAMPLE
) -> Model | None:
    """The model from a bounded sample of labelled rows; None if a class is missing.

    Features are counted and chosen on the executors; the driver gets the counts of
    the chosen ones in the sample's texts.
    """
    sample, totals = _sample(docs, labels, label, id_col, text_col, sizes)
    if any(not totals.get(k) for k in (0, 1)):
        return None
    counts = written(_counts(sample), "toxic-counts")
    # As many rows as ``sizes`` say at most.
    rows = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.countDistinct("row").alias("n")).collect()}
    if len(rows) < 2:
        discard(counts)
        return None
    stats = counts.groupBy("feature").agg(
        *(F.countDistinct(F.when(F.col("label") == 1, F.col(x))).alias(name) for x, name in (("least", "sentences"), ("around", "texts"))),
        *(F.sum(F.when(F.col("label") == k, 1).otherwise(0)).alias(f"in_{k}") for k in (0, 1)),
    )
    speaks = (F.col("in_1") / F.lit(rows[1])) >= MIN_RATIO * (F.col("in_0") + 0.5) / F.lit(rows[0])
    # BUCKETS rows at most.
    various = (F.col("sentences") >= MIN_SENTENCES) | (F.col("texts") >= F.greatest(F.lit(MIN_SENTENCES), F.col("in_1") / 2))
    chosen = stats.where(various).where(speaks).select(F.col("feature").alias("chosen"))
    got = counts.join(F.broadcast(chosen), F.col("feature") == F.col("chosen"), "left_semi").orderBy("id", "row", "feature").select("row", "label", "feature", "n").toArrow()
    discard(counts)
    _, first, text_of = np.unique(got["row"].to_numpy(), return_index=True, return_inverse=True)
    label_of = got["label"].to_numpy()[first].astype(np.int64)
    # The sample's classes count as much as all labelled rows of them do.
    shares = [totals[k] / rows[k] for k in (0, 1)]
    weight = tuple(float(x / shares[1]) for x in shares)
    return Model(fit(text_of, label_of, got["feature"].to_numpy(), got["n"].to_numpy().astype(np.float64), weight))


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the probability that the text is toxic, and that column's name."""
    (name,) = fresh(docs, "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value

        def run(batch: list[bytes | None]) -> list[pa.Array]:
            return [pa.array([model.score(x) if model else 0.0 for x in batch], pa.float64())]

        return run

    return append_columns(docs, text_col, [T.StructField(name, T.DoubleType())], make), name


def offending(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, str]:
    """``docs`` with the toxic sentences as an array of (start, end, score), in code points, and that column's name."""
    (name,) = fresh(docs, "offending")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def make():
        model = sent.value

        def find(raw: bytes | None) -> list[dict]:
            out = []
            for m in _SENTENCE.finditer(raw.decode()) if raw and model else ():
                for ws in sentences(m[0].encode()):
                    if (p := model.sentence(ws)) >= threshold:
                        out.append({"start": m.start(), "end": m.end(), "score": p})
            return out

        return lambda batch: [pa.array([find(x) for x in batch], arrow)]

    return append_columns(docs, text_col, [T.StructField(name, kind)], make), name


def reject_toxic(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more, with the same columns."""
    scored, s = score(docs, train(docs, labels, label, id_col, text_col), text_col)
    return scored.where(col(s) < threshold).select(*(col(c) for c in docs.columns))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    docs = docs.select("doc_id", "text")
    scored, s = score(docs, train(docs, labels))
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), col(s).alias("score"), F.when(col(s) >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted")
    )
