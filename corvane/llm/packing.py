"""Best-two-fit packing of tokenised documents into sequences.

Texts become token ids; documents beyond a sequence's length are cut into pieces.
The packing itself is decided on the histogram of piece lengths, which has one
counter for each possible length however large the corpus is: a sequence is
filled greedily with the longest pieces that fit, then its shortest piece is
replaced by the two pieces that fill the widened gap more tightly, and the same
sequence is repeated as often as the counters allow. Pieces of one length are
interchangeable, so each takes its place by its rank among those of its length;
ranks are counted in each partition and offset by a prefix sum over partitions.

Edge cases: a null or empty text is one piece that holds the end-of-document id
alone. Rows with the same id, or a null one, are packed each on its own. An empty
table gives no pieces. A special token's string in a text becomes its special id,
as the tokenizer has it.
"""

from __future__ import annotations

import json
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import SLICE_BYTES, col, map_rows, small_slices, texts, written

SEQUENCE = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
#: Space-separated chunks whose ids a worker remembers.
CACHE = 300_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _buffers(array: pa.Array) -> tuple[np.ndarray, bytes]:
    """Offsets and bytes of an array of large binaries that is no slice of another."""
    _, offsets, raw = array.buffers()
    return np.frombuffer(offsets, dtype=np.int64, count=len(array) + 1), raw.to_pybytes() if raw else b""


class Encoder:
    """Ids of texts as little-endian 32-bit bytes.

    This tokenizer lower-cases, drops white space and never joins what it
    separates, so the ids of a text are those of its chunks, one after another.
    Chunks end at ASCII white space and before punctuation that ends a word; their
    ids are remembered, and those not yet known are encoded together. A batch's
    chunks are cut and counted as arrays, and each different one is looked up once.
    ``specials``: whether the special tokens' strings in a text become their ids,
    or are text like any other. Texts that may hold one are encoded whole.
    """

    #: White space, ASCII letters and digits, other ASCII punctuation, and the rest, by byte.
    _SPACE, _WORD, _MARK, _REST = range(4)
    _KIND = np.full(256, _REST, dtype=np.uint8)
    _KIND[list(b" \t\n\r\x0b\x0c")] = _SPACE
    _KIND[list(string.punctuation.encode())] = _MARK
    _KIND[list(string.digits.encode() + string.ascii_lowercase.encode())] = _WORD
    #: Letters that neither compose nor turn into anything but one letter each: a chunk of them is one word.
    _LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")  # U+00C0 to U+00FF without the two signs
    _GAP = re.compile(rb"[ \t\n\r\x0b\x0c]")
    #: Chunks that are encoded at a time, and bytes of one that is remembered.
    GROUP, LONG = 100, 64

    def __init__(self, path: str, specials: bool = True, size: int = CACHE) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.size = Tokenizer.from_file(path), size
        self.tokenizer.encode_special_tokens = not specials
        # The same merges for words of such letters, which need neither its normalizer nor its pattern.
        layout = json.loads(self.tokenizer.to_str())
        layout["normalizer"], layout["added_tokens"] = None, []
        layout["pre_tokenizer"]["pretokenizers"][0] = {"type": "WhitespaceSplit"}
        self.merges = Tokenizer.from_str(json.dumps(layout))
        vocabulary = self.merges.get_vocab()
        #: Whether an id ends a word.
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True
        #: Remembered chunks, and those remembered before ``known`` was last full: what is still in use moves over.
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, chunks: list[bytes]) -> None:
        words = list(filter(self._LETTERS.fullmatch, chunks))
        others = list(set(chunks).difference(words))
        for at in range(0, len(words), self.GROUP):
            group = words[at : at + self.GROUP]
            (got,) = self.merges.encode_batch_fast([b" ".join(group).decode().lower()], add_special_tokens=False)
            ids = np.array(got.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(group):
                raise ValueError("a chunk of letters is not one word of the tokenizer")
            self._remember(group, ids, ends)
        for at in range(0, len(others), self.GROUP):
            group = others[at : at + self.GROUP]
            parts = [x.decode() for x in group]
            got = self.tokenizer.encode(" ".join(parts), add_special_tokens=False)
            starts = np.cumsum([0, *(len(x) + 1 for x in parts[:-1])])
            of = np.searchsorted(starts, np.array([x for x, _ in got.offsets], dtype=np.int64), side="right") - 1
            self._remember(group, np.array(got.ids, dtype="<u4"), np.cumsum(np.bincount(of, minlength=len(group))))

    def _remember(self, group: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        raw, start = ids.tobytes(), 0
        for x, end in zip(group, (4 * ends).tolist()):
            self.known[x] = raw[start:end]
            start = end

    def _chunks(self, batch: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The chunks of lower-cased texts, and where each text's begin among them, and end."""
        buf = np.frombuffer(b"\n".join([b"", *batch, b""]), dtype=np.uint8)
        kind = self._KIND[buf]
        solid = kind != self._SPACE
        first, last = solid[1:] & ~solid[:-1], solid[:-1] & ~solid[1:]
        # Punctuation between an ASCII letter or digit and white space: a run of its own in this tokenizer, too.
        marks = np.flatnonzero(kind == self._MARK)
        if len(marks):
            apart = np.diff(marks) > 1
            runs, stops = marks[np.r_[True, apart]], marks[np.r_[apart, True]] + 1
            cuts = runs[(kind[runs - 1] == self._WORD) & (kind[stops] == self._SPACE)] - 1
            first[cuts] = last[cuts] = True
        starts, stops = np.flatnonzero(first) + 1, np.flatnonzero(last) + 1
        offsets = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(stops - starts, out=offsets[1:])
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buf[solid])])
        bounds = np.cumsum([0, *(len(x) + 1 for x in batch)])
        return chunks, np.searchsorted(starts, bounds)

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of different chunks."""
        missing = [x for x, ids in zip(chunks, map(self.known.get, chunks)) if ids is None]
        if len(self.known) + len(missing) > self.size // 2:
            self.known, self.before, missing = {}, self.known, chunks
        self.known.update((x, ids) for x, ids in zip(missing, map(self.before.get, missing)) if ids is not None)
        self._learn([x for x in missing if x not in self.known])
        out = list(map(self.known.__getitem__, chunks))
        for x in missing:
            if len(x) > self.LONG:
                del self.known[x]
        return out

    def _parts(self, text: bytes) -> list[bytes]:
        """A text in parts of about SLICE_BYTES that end before white space."""
        out = []
        while len(text) > 2 * SLICE_BYTES and (gap := self._GAP.search(text, SLICE_BYTES)):
            out.append(text[: gap.start()])
            text = text[gap.start() :]
        return [*out, text]

    def encode(self, batch: list[bytes | None]) -> list[bytes]:
        lows = [raw.lower() if raw else b"" for raw in batch]  # ASCII letters alone; the tokenizer sees to the others
        special = {i for i, low in enumerate(lows) if b"<|" in low}
        plain = [b"" if i in special else low for i, low in enumerate(lows)]
        if len(plain) == 1 and len(parts := self._parts(plain[0])) > 1:
            return [b"".join(self.encode([x])[0] for x in parts)]
        chunks, bounds = self._chunks(plain)
        if not len(chunks):
            out = [b""] * len(batch)
        else:
            coded = chunks.dictionary_encode()
            offsets, raw = _buffers(coded.dictionary)
            different = [raw[s:e] for s, e in zip(offsets.tolist(), offsets[1:].tolist())]
            offsets, raw = _buffers(pa.array(self._ids(different), pa.large_binary()).take(coded.indices))
            at = offsets[bounds].tolist()
            out = [raw[s:e] for s, e in zip(at, at[1:])]
        for i in special:
            out[i] = self.whole(batch[i])
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, specials: bool = True) -> Encoder:
    """One encoder of a kind in each Python worker."""
    if (path, specials) not in _ENCODERS:
        _ENCODERS[path, specials] = Encoder(path, specials)
    return _ENCODERS[path, specials]


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = SEQUENCE, vocabulary: str | None = None, with_ids: bool = False
) -> DataFrame:
    """The pieces of every document: id, piece, start, length, ids_crc32, part, rank [, ids].

    ``rank`` numbers the pieces of the same length within ``part``, the partition.
    """
    path = vocabulary or vocabulary_path()
    fields = [docs.schema[id_col]]
    fields = [T.StructField("doc_id", fields[0].dataType)] + [
        T.StructField(n, t())
        for n, t in (("piece", T.IntegerType), ("start", T.LongType), ("length", T.LongType), ("ids_crc32", T.LongType), ("part", T.IntegerType), ("rank", T.LongType))
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        ranks = [0] * (length + 1)
        encode = encoder(path).encode
        for whole in batches:
            for batch in small_slices(whole, 1):
                of, piece, start, size, crc, rank, ids = [], [], [], [], [], [], []
                for row, raw in enumerate(encode(texts(batch, 1))):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), 4 * length)):
                        own = raw[at : at + 4 * length]
                        n = len(own) // 4
                        of.append(row)
                        piece.append(k)
                        start.append(at // 4)
                        size.append(n)
                        crc.append(zlib.crc32(own))
                        rank.append(ranks[n])
                        ranks[n] += 1
                        if with_ids:
                            ids.append(own)
                out = [
                    batch.column(0).take(pa.array(of, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, size, crc)),
                    pa.array(np.full(len(of), part, dtype=np.int32)),
                    pa.array(rank, pa.int64()),
                ]
                yield out + ([pa.array(ids, pa.binary())] if with_ids else [])

    return map_rows(docs.select(col(id_col), col(text_col)), run, T.StructType(fields))


def plan(counts: dict[int, int], length: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Sequences for ``counts`` pieces of each length: (how many alike, [(piece length, how many in each)]).

    Every step uses up at least one length's counter down to less than a sequence
    takes of it, so there are a few thousand steps at most.
    """
    left = np.zeros(length + 1, dtype=np.int64)
    for n, c in counts.items():
        left[n] = c
    sizes = np.arange(length + 1)
    out = []
    while True:
        free = left.copy()
        longest = np.maximum.accumulate(np.where(free > 0, sizes, 0))  # the longest piece of at most x that is left

        def take(n: int) -> None:
            free[n] -= 1
            if free[n] == 0:
                longest[:] = np.maximum.accumulate(np.where(free > 0, sizes, 0))

        if not longest[length]:
            return out
        held, gap = [], length
        while n := int(longest[gap]):
            take(n)
            held.append(n)
            gap -= n
        if gap and len(held) > 1:
            small = held[-1]  # pieces were taken from the longest down
            wide = gap + small
            first = np.flatnonzero(free[: wide + 1] > 0)
            if len(first):
                second = longest[wide - first]
                # Two of the same length need two of them.
                twin = (second == first) & (free[first] < 2)
                for i in np.flatnonzero(twin).tolist():
                    lower = np.flatnonzero(free[: int(first[i])] > 0)
                    second[i] = lower[-1] if len(lower) else 0
                total = np.where(second > 0, first + second, 0)
                best = int(total.argmax())
                if total[best] > small:
                    held.pop()
                    held += sorted((int(first[best]), int(second[best])), reverse=True)
        kinds = sorted({n: held.count(n) for n in held}.items(), reverse=True)
        times = int(min(left[n] // k for n, k in kinds))
        for n, k in kinds:
            left[n] -= times * k
        out.append((times, kinds))


def slots(steps: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """For each piece length the rows (first rank, first sequence, pieces in each sequence, offset)."""
    found: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for times, kinds in steps:
        offset = 0
        for n, k in kinds:
            found.setdefault(n, []).append((ranks.get(n, 0), sequence, k, offset))
            ranks[n] = ranks.get(n, 0) + times * k
            offset += n * k
        sequence += times
    return {n: np.array(x, dtype=np.int64) for n, x in found.items()}


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = SEQUENCE, vocabulary: str | None = None, with_ids: bool = False
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset [, ids]."""
    cuts = written(pieces(docs, id_col, text_col, length, vocabulary, with_ids), "pieces")
    of_part = cuts.groupBy("part", "length").agg(F.count("*").alias("n"))
    # One row for each length: the histogram.
    counts = {int(r["length"]): int(r["n"]) for r in of_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    sent = docs.sparkSession.sparkContext.broadcast(slots(plan(counts, length)))
    from pyspark.sql import Window

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = of_part.select(
        F.col("part").alias("b_part"), F.col("length").alias("b_length"), F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base")
    )
    ranked = cuts.join(bases, (F.col("part") == F.col("b_part")) & (F.col("length") == F.col("b_length")))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = ranked.select(*keep, (F.col("rank") + F.col("base")).alias("rank"))
    schema = T.StructType(
        [ranked.schema[c] for c in keep] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        places = sent.value
        for batch in batches:
            size, rank = (np.asarray(batch.column(i)) for i in (3, len(keep)))
            sequence, offset = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
            order = np.argsort(size, kind="stable")
            edges = np.r_[np.flatnonzero(np.diff(size[order], prepend=-1)), len(order)]
            for s, e in zip(edges[:-1], edges[1:]):
                rows = order[s:e]
                n = int(size[rows[0]])
                place = places[n]
                at = place[np.searchsorted(place[:, 0], rank[rows], side="right") - 1]
                more = rank[rows] - at[:, 0]
                sequence[rows] = at[:, 1] + more // at[:, 2]
                offset[rows] = at[:, 3] + more % at[:, 2] * n
            yield [*batch.columns[: len(keep)], pa.array(sequence), pa.array(offset)]

    return map_rows(ranked, run, schema)
