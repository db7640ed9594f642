"""Quality rules: fixed base rules, then a calibrated classifier on hashed n-grams.

The classifier is a logistic regression over hashed word unigrams and bigrams and
hashed character trigrams, each as shares of the text, trained on labelled rows.
Every fifth row of each class is kept from training and calibrates the margin by
Platt scaling, weighted so that the classes have the shares that they have among
all labelled rows; a class of fewer than five rows calibrates on what it was
trained on. Documents are scored in Arrow batches against a fixed threshold.

Edge cases: a null or empty text has no words, zero counts, and fails the base
rules. Labels of null, and ids without a document, are ignored. Repeated label
rows count as often as they occur. Without labels of both classes there is no
classifier, and the base rules decide alone. Long texts are hashed in pieces that
overlap by a word, so that memory is bounded and no n-gram is lost. Ids may be of
any type.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import append_columns, col, fresh, small_slices, texts

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Labelled rows in the training sample, at most, for each class.
SAMPLE_PER_CLASS = 1500
#: Features of words and of characters.
BUCKETS = 1 << 15
#: Calibrated probability of good quality from which a document is kept.
THRESHOLD = 0.5

_SPACE = b" \t\n\x0b\x0c\r"
_TAIL = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
#: Characters that are hashed at a time, and the longest stretch looked through for a place to cut.
PIECE, LONG = 1 << 20, 1 << 12
_SPACES = np.isin(np.arange(256), list(_SPACE))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.cumprod(np.r_[np.uint64(1), np.full(LONG - 1, 1099511628211, dtype=np.uint64)], dtype=np.uint64)


def base_counts(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    ws = text.split()
    n = len(ws)
    chars = len(text.translate(None, _TAIL + _SPACE))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    repeated = 0
    if n > 3:
        windows = list(zip(ws, ws[1:], ws[2:]))
        if len(set(windows)) < len(windows):
            count = Counter(windows)
            end = 0  # words before it are counted
            for i, w in enumerate(windows):
                if count[w] > 1:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def pieces(text: bytes | None) -> list[tuple[np.ndarray, int]]:
    """Code points of a text in pieces of about PIECE, and how many at the start of each repeat the last word of the one before.

    A piece ends before a space, where there is one. The overlap joins the n-grams across the cut.
    """
    points = np.frombuffer((text or b"").decode().encode("utf-32-le"), dtype="<u4")
    out, start, repeated = [], 0, 0
    while len(points) - start > 2 * PIECE:
        end = start + PIECE
        low = max(start + repeated, end - LONG)
        space = _SPACES[np.minimum(points[low:end], 255)]
        ends = np.flatnonzero(space[1:] & ~space[:-1])  # the last characters of words
        if len(ends):
            end = low + int(ends[-1]) + 1
        out.append((points[start:end], repeated))
        low = max(start, end - LONG)
        before = np.flatnonzero(_SPACES[np.minimum(points[low:end], 255)])
        repeated = max(end - low - 1 - int(before[-1]) if len(before) else 0, 2)
        start = end - repeated
    out.append((points[start:], repeated))
    return out


def features(batch: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Numbers of the word unigrams, word bigrams and character trigrams of each text.

    Words are in [0, BUCKETS), trigrams of characters in [BUCKETS, 2 * BUCKETS).
    All words and characters of a batch are hashed at once, long texts in pieces.
    """
    out, group, size = [], [], 0
    parts = [(i, *x) for i, text in enumerate(batch) for x in pieces(text)]
    found: list[list] = [[] for _ in batch]
    for k, (i, points, repeated) in enumerate(parts):
        group.append((i, points, repeated))
        size += len(points)
        if size >= PIECE or k == len(parts) - 1:
            for (j, _, _), grams in zip(group, _hashed([(p, r) for _, p, r in group])):
                found[j].append(grams)
            group, size = [], 0
    for grams in found:
        out.append(tuple(np.concatenate([g[n] for g in grams]) if len(grams) > 1 else grams[0][n] for n in range(3)))
    return out


def _hashed(group: list[tuple[np.ndarray, int]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    gap = np.full(3, 10, dtype=np.uint32)
    data = np.concatenate([gap, *(x for p, _ in group for x in (p, gap))])
    sizes = np.array([len(p) for p, _ in group], dtype=np.int64)
    begin = 3 + np.r_[0, np.cumsum(sizes + 3)[:-1]]
    end = begin + sizes

    # Words: a polynomial hash of each run of characters that aren't space.
    space = _SPACES[np.minimum(data, 255)]
    edge = np.flatnonzero(np.diff(space.view(np.int8)))  # data begins and ends with space
    first, last = edge[::2] + 1, edge[1::2] + 1
    word = np.zeros(0, dtype=np.uint64)
    if len(first):
        length = last - first
        # Of a very long word, what stands LONG characters apart has the same factor.
        place = np.flatnonzero(~space) - np.repeat(first, length)
        terms = (data[~space].astype(np.uint64) + np.uint64(1)) * _POWER[place % LONG] + (place // LONG).astype(np.uint64)
        word = np.add.reduceat(terms, np.r_[0, np.cumsum(length)[:-1]])
        word ^= word >> np.uint64(29)
        word *= _FACTOR
        word ^= word >> np.uint64(32)
    bounds = np.searchsorted(first, np.r_[begin, end[-1:]])
    pair = np.zeros_like(word)
    if len(word):
        pair[1:] = word[:-1] * np.uint64(31) + word[1:]
        pair ^= pair >> np.uint64(31)
        pair *= _FACTOR
    heads = np.zeros(len(word), dtype=bool)
    heads[bounds[:-1][bounds[:-1] < len(word)]] = True
    one = (word >> np.uint64(40)).astype(np.int64) % BUCKETS
    two = np.where(heads, one, (pair >> np.uint64(40)).astype(np.int64) % BUCKETS)

    wide = data.astype(np.uint64)
    three = (wide[:-2] * np.uint64(0x10001) + wide[1:-1]) * np.uint64(0x10003) + wide[2:]
    three *= _FACTOR
    three = (three >> np.uint64(44)).astype(np.int64) % BUCKETS + BUCKETS
    out = []
    for k, (_, repeated) in enumerate(group):
        s, e = bounds[k], bounds[k + 1]
        again = 1 if s < e and first[s] < begin[k] + repeated else 0  # the word that the piece before ends with
        from_ = begin[k] + max(repeated - 2, 0)
        out.append((one[s + again : e], two[s + again : e], three[from_ : max(end[k] - 2, from_)]))
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    #: Platt scaling of the margin.
    slope: float
    offset: float

    def probabilities(self, batch: list[bytes | None]) -> np.ndarray:
        """Calibrated probability of class 1 for each text."""
        margins = np.array([self.margin(*x) for x in features(batch)]) if batch else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))

    def margin(self, one: np.ndarray, two: np.ndarray, three: np.ndarray) -> float:
        out = self.bias
        if len(one):
            out += float(self.weights[one].mean() + self.weights[two].mean())
        if len(three):
            out += float(self.weights[three].mean())
        return out


def _sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, per_class: int, salt: int) -> tuple[DataFrame, dict[int, int]]:
    """Texts of up to ``per_class`` labelled rows of each class, those whose ids hash lowest, and how many rows each class has in all."""
    rows = labels.select(col(id_col).alias("s_id"), col(label).cast("int").alias("s_label")).where("s_id is not null and s_label in (0, 1)")
    totals = {r["s_label"]: r["count"] for r in rows.groupBy("s_label").count().collect()}
    order = F.xxhash64(F.lit(salt), "s_id")
    chosen = reduce(DataFrame.unionByName, [rows.where(F.col("s_label") == k).orderBy(order, "s_id").limit(per_class) for k in (0, 1)])
    texts_ = docs.select(col(id_col).alias("t_id"), col(text_col).alias("t_text"))
    # Two times per_class small rows at most: this side is bounded whatever the corpus holds.
    return texts_.join(F.broadcast(chosen), F.col("t_id") == F.col("s_id")).select(F.xxhash64("s_id"), "s_label", "t_text"), totals


def labelled_features(sample: DataFrame) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Labels and sparse features (numbers, shares) of a bounded sample; texts stay on the executors."""
    schema = "id long, label int, at array<int>, share array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, 2):
                at, share = [], []
                for grams in features(texts(batch, 2)):
                    total = np.zeros(2 * BUCKETS, dtype=np.float64)
                    for x in grams:
                        if len(x):
                            total += np.bincount(x, minlength=2 * BUCKETS) / len(x)
                    nz = np.flatnonzero(total)
                    at.append(nz.astype(np.int32))
                    share.append(total[nz].astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(at, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))],
                    names=["id", "label", "at", "share"],
                )

    rows = sample.mapInArrow(run, schema).toArrow()
    order = np.lexsort([rows["label"].to_numpy(), rows["id"].to_numpy()])  # the fit doesn't hang on the order of arrival
    at, share = rows["at"].combine_chunks(), rows["share"].combine_chunks()
    out = [(np.asarray(at[int(i)].values), np.asarray(share[int(i)].values)) for i in order]
    return rows["label"].to_numpy()[order].astype(np.float64), out


def fit(
    labels: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], totals: dict[int, int] | None = None, steps: int = 150, decay: float = 1e-4
) -> Model | None:
    """Logistic regression by accelerated gradient steps on rescaled features; every fifth row of a class calibrates.

    ``totals`` are the numbers of rows that the classes have outside the sample.
    """
    if len(set(labels.tolist())) < 2:
        return None
    held = np.zeros(len(rows), dtype=bool)
    for k in (0, 1):
        held[np.flatnonzero(labels == k)[4::5]] = True
    train = np.flatnonzero(~held)
    at = np.concatenate([rows[i][0] for i in train]).astype(np.int64)
    share = np.concatenate([rows[i][1] for i in train]).astype(np.float64)
    of = np.repeat(np.arange(len(train)), [len(rows[i][0]) for i in train])
    y = labels[train]
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    balance /= balance.sum()
    scale = 1 / (np.sqrt(np.bincount(at, weights=share**2, minlength=2 * BUCKETS) / len(train)) + 1e-4)
    value = share * scale[at]
    # Rows of equal length keep the step size independent of a text's length.
    norm = np.sqrt(np.bincount(of, weights=value**2, minlength=len(train))).mean() + 1e-9
    value /= norm
    w, b = np.zeros(2 * BUCKETS), 0.0
    mw, mb, vw, vb = w.copy(), 0.0, w.copy(), 0.0
    for k in range(steps):
        z = np.bincount(of, weights=value * w[at], minlength=len(train)) + b
        r = balance * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        gw, gb = np.bincount(at, weights=value * r[of], minlength=2 * BUCKETS) + decay * w, r.sum()
        mw, mb = 0.9 * mw + 0.1 * gw, 0.9 * mb + 0.1 * gb
        vw, vb = 0.99 * vw + 0.01 * gw**2, 0.99 * vb + 0.01 * gb**2
        up = 0.05 / (1 - 0.9 ** (k + 1))
        root = np.sqrt(1 - 0.99 ** (k + 1))
        w = w - up * root * mw / (np.sqrt(vw) + 1e-8)
        b = b - up * root * mb / (np.sqrt(vb) + 1e-8)
    model = Model((w * scale / norm).astype(np.float64), float(b), 1.0, 0.0)
    use = np.concatenate([np.flatnonzero(held & (labels == k)) if held[labels == k].any() else np.flatnonzero(labels == k) for k in (0, 1)])
    margin = np.array([model.bias + float(model.weights[rows[i][0]] @ rows[i][1]) for i in use])
    share = [(totals or {}).get(k) or int((labels == k).sum()) for k in (0, 1)]
    weight = np.array([share[int(k)] / (labels[use] == k).sum() for k in labels[use]])
    return Model(model.weights, model.bias, *platt(margin, labels[use], weight / weight.mean()))


def platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the calibrating logistic, by weighted Newton steps on smoothed targets."""
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    spread = margin.std() + 1e-9
    x = np.column_stack([margin / spread, np.ones(len(y))])
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -500, 500)))
        hessian = x.T @ (x * (weight * p * (1 - p) + 1e-9)[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (p - target)))
        theta = theta - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0] / spread), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """The classifier of ``label``, from a bounded sample of labelled rows; None if a class is missing."""
    sample, totals = _sample(docs, labels, label, id_col, text_col, per_class, salt=3)
    return fit(*labelled_features(sample), totals)


def judge(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, list[str]]:
    """``docs`` with the base counts, base_failed, the probability (null without a model) and the verdict; and those columns' names."""
    names = fresh(docs, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "probability", "kept")
    kinds = [T.LongType()] * 5 + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value

        def run(batch: list[bytes | None]) -> list[pa.Array]:
            counts = np.array([base_counts(x) for x in batch], dtype=np.int64).reshape(-1, 5)
            failed = (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])
            if model is None:
                p, kept = pa.nulls(len(batch), pa.float64()), ~failed
            else:
                p = model.probabilities(batch)
                kept = ~failed & (p >= threshold)
            return [*(pa.array(counts[:, i]) for i in range(5)), pa.array(failed), pa.array(p), pa.array(kept)]

        return run

    return append_columns(docs, text_col, [T.StructField(n, k) for n, k in zip(names, kinds)], make), names


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, kept."""
    docs = docs.select("doc_id", "text")
    out, names = judge(docs, train(docs, labels))
    return out.select("doc_id", *(x for x in names if x != "probability"))
