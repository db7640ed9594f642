"""Line dedup by range-partitioned hashes with a secondary sort.

Every line becomes (128-bit hash of its key, document, position). The hashes are
range-partitioned together with the document and the position, so that a key that
a large part of the corpus holds is cut over many partitions, and each partition
is sorted by hash, document and position. A stream over the sorted rows counts the
documents of each key and knows its first occurrence. Only the first and the last
key of a partition can go on in another; their counts, two rows for each
partition, are summed and sent back. What returns to the documents is a compressed
bitmap of the lines to keep, for those that lose any. A bit table of FILTER_BITS,
broadcast, tells which documents may have one; only those are shuffled to meet
their bitmaps, and the others stay where they are.

Edge cases: a null or empty text is one empty line. An empty key (a blank line)
is never dropped. Rows with the same document id are one document for the count;
a null id is one document too. Repeated rows get the same answer, also where the
first occurrence of a line is kept. Ids that are no integers count by a 64-bit hash.
A text of which every line goes becomes empty. Carriage returns belong to the stripped space.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import col, fresh, map_rows, number, scratch, small_slices, texts, written

MIN_DOCS = 10
MIN_CHARS = 1
#: Bits of the table that tells which documents may lose lines; 64 of them are a row of the broadcast.
FILTER_BITS = 1 << 26
_SPACE = b" \t\n\x0b\x0c\r"
#: Not the first byte of a code point.
_TAIL = bytes(range(0x80, 0xC0))

_LINES = T.StructType(
    [T.StructField(n, T.LongType(), n in ("doc", "text_hash")) for n in ("high", "low", "doc", "text_hash", "position")]
)


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()  # bytes.lower() folds A-Z alone


def _pieces(text: bytes | None) -> list[bytes]:
    return (text or b"").split(b"\n")


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(col(text_col), F.lit("")))


def line_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row (key hash, document, text hash, position) for each line with a key of ``min_chars`` code points at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        digest = xxhash.xxh3_128_digest
        for whole in batches:
            for batch in small_slices(whole, 1):
                hashes, counts, positions = [], [], []
                for text in texts(batch, 1):
                    keys = [line_key(x) for x in _pieces(text)]
                    if min_chars <= 1:
                        at = [i for i, k in enumerate(keys) if len(k) >= min_chars]
                    else:
                        at = [i for i, k in enumerate(keys) if len(k.translate(None, _TAIL)) >= min_chars]
                    hashes += [digest(keys[i]) for i in at]
                    positions += at
                    counts.append(len(at))
                both = np.frombuffer(b"".join(hashes), dtype=">i8").reshape(-1, 2).astype(np.int64)
                of = pa.array(np.repeat(np.arange(len(counts)), counts))
                yield [
                    pa.array(both[:, 0]),
                    pa.array(both[:, 1]),
                    batch.column(0).take(of),
                    batch.column(2).take(of),
                    pa.array(np.array(positions, dtype=np.int64)),
                ]

    return map_rows(docs.select(number(docs, id_col), col(text_col), _text_hash(text_col)), run, _LINES)


_FOUND = T.StructType(
    [
        T.StructField("part", T.IntegerType(), False),
        T.StructField("high", T.LongType(), False),
        T.StructField("low", T.LongType(), False),
        #: Documents that hold the key, in this partition; null in a row of a line.
        T.StructField("n_docs", T.LongType()),
        #: Whether the key may go on in another partition.
        T.StructField("edge", T.BooleanType(), False),
        #: Whether the line is the first with its key in this partition, or a repeated row's copy of the first.
        T.StructField("first", T.BooleanType(), False),
        T.StructField("doc", T.LongType()),
        T.StructField("text_hash", T.LongType()),
        T.StructField("position", T.LongType()),
        #: In a summary row, the last document with the key; ``doc`` and ``text_hash`` have the first.
        T.StructField("last_doc", T.LongType()),
        T.StructField("last_hash", T.LongType()),
    ]
)


def _stream(min_docs: int):
    """Reads sorted lines; gives the lines of keys that are, or may be, in ``min_docs`` documents.

    Keys inside a partition are settled there. Of the first and the last key,
    which other partitions may hold too, the lines go out together with a summary
    row (without position). Held at a time: a batch, and the key that is going on.
    """

    def rows(block: np.ndarray, part: int, edge: bool, first: np.ndarray) -> list[pa.Array]:
        n = len(block)
        return [
            pa.array(np.full(n, part, dtype=np.int32)),
            pa.array(block[:, 0]),
            pa.array(block[:, 1]),
            pa.nulls(n, pa.int64()),
            pa.array(np.full(n, edge)),
            pa.array(first),
            pa.array(block[:, 2], mask=block[:, 3].astype(bool)),
            pa.array(block[:, 4]),
            pa.array(block[:, 5]),
            *[pa.nulls(n, pa.int64())] * 2,
        ]

    def summary(block: np.ndarray, part: int, n_docs: int) -> list[pa.Array]:
        (high, low, *first), last = block[0].tolist(), block[-1].tolist()
        doc, last_doc = (None if x else d for d, x in (first[:2], last[2:4]))
        one = [part, high, low, n_docs, True, False, doc, first[2], None, last_doc, last[4]]
        return [pa.array([v], t) for v, t in zip(one, _ARROW)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        hand: list[np.ndarray] = []  # the rows of the key that is going on
        inner = False  # whether a key has ended in this partition

        def settle(last: bool) -> Iterator[list[pa.Array]]:
            block = np.concatenate(hand)
            n_docs = 1 + int((block[1:, 2:4] != block[:-1, 2:4]).any(axis=1).sum())
            edge = last or not inner
            if edge or n_docs >= min_docs:
                yield rows(block, part, edge, (block == block[0]).all(axis=1))
            if edge:
                yield summary(block, part, n_docs)

        for batch in batches:
            if not batch.num_rows:
                continue
            # columns: high, low, document, whether that is null, text hash, position
            high, low, doc, text_hash, position = (np.asarray(batch.column(i).fill_null(0)) for i in range(5))
            block = np.column_stack([high, low, doc, np.asarray(batch.column(2).is_null()).astype(np.int64), text_hash, position])
            new = np.r_[True, (block[1:, :2] != block[:-1, :2]).any(axis=1)]
            starts = np.flatnonzero(new)
            if hand and (hand[-1][-1, :2] == block[0, :2]).all():
                hand.append(block[: starts[1]] if len(starts) > 1 else block)
                starts = starts[1:]
            if not len(starts):
                continue
            if hand:
                yield from settle(False)
                inner = True
            if not inner and len(starts) > 1:  # the partition's first key ends within its first batch
                hand = [block[: starts[1]]]
                yield from settle(False)
                inner, starts = True, starts[1:]
            if len(starts) > 1:
                new_doc = new | np.r_[True, (block[1:, 2:4] != block[:-1, 2:4]).any(axis=1)]
                n_docs = np.add.reduceat(new_doc[: starts[-1]].astype(np.int64), starts[:-1])
                size = np.diff(starts)
                chosen = np.zeros(len(block), dtype=bool)
                chosen[starts[0] : starts[-1]] = np.repeat(n_docs >= min_docs, size)
                if chosen.any():
                    leader = np.maximum.accumulate(np.where(new, np.arange(len(block)), 0))
                    yield rows(block[chosen], part, False, (block == block[leader]).all(axis=1)[chosen])
            hand = [block[starts[-1] :]]
        if hand:
            yield from settle(True)

    return run


_ARROW = [pa.int32(), *[pa.int64()] * 3, *[pa.bool_()] * 2, *[pa.int64()] * 5]


def dropped_lines(lines: DataFrame, min_docs: int = MIN_DOCS, keep: str = "none") -> DataFrame:
    """(doc, text_hash, position) of the lines to drop.

    ``keep="none"`` drops every line of a key in ``min_docs`` documents,
    ``keep="first"`` all but the first by document and position. Repeated rows get
    one answer, so where the first stands in a repeated row it stays in every copy.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep: {keep!r}")
    order = ["high", "low", "doc", "text_hash", "position"]
    # Range partitioning samples its input first; the lines are hashed once for that and for the sort.
    dealt = written(lines, "line-hashes").repartitionByRange(*order).sortWithinPartitions(*order)
    found = written(map_rows(dealt, _stream(min_docs), _FOUND), "lines")
    # Two rows for each partition at most, whatever the corpus holds.
    edges = found.where("edge and position is null").select(F.col("high").alias("t_high"), F.col("low").alias("t_low"), "part", "n_docs", "doc", "last_doc")
    before = Window.partitionBy("t_high", "t_low").orderBy("part")
    # A document that goes on in the next partition was counted in both.
    again = F.lag("part").over(before).isNotNull() & F.col("doc").eqNullSafe(F.lag("last_doc").over(before))
    totals = (
        edges.select("t_high", "t_low", "part", (F.col("n_docs") - again.cast("int")).alias("n_docs"))
        .groupBy("t_high", "t_low")
        .agg(F.sum("n_docs").alias("t_docs"), F.min("part").alias("t_part"))
        .where(F.col("t_docs") >= min_docs)
    )
    rows = found.where("position is not null")
    inner = rows.where("not edge").select("doc", "text_hash", "position", "first")
    outer = (
        rows.where("edge")
        .join(F.broadcast(totals), (F.col("high") == F.col("t_high")) & (F.col("low") == F.col("t_low")))
        .select("doc", "text_hash", "position", (F.col("first") & (F.col("part") == F.col("t_part"))).alias("first"))
    )
    out = inner.unionByName(outer)
    return (out.where("not first") if keep == "first" else out).select("doc", "text_hash", "position")


def bitmap(positions: list[int]) -> bytes:
    """Compressed bitmap with a 0 for each position given, and 1 elsewhere."""
    bits = np.ones((max(positions) // 8 + 1) * 8, dtype=np.uint8)
    bits[positions] = 0
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes())


def apply_bitmap(text: bytes | None, packed: bytes | None) -> tuple[int, int, bytes]:
    """Lines, dropped lines and the text that stays."""
    lines = _pieces(text)
    if not packed:
        return len(lines), 0, text or b""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8), bitorder="little")[: len(lines)]
    gone = set(np.flatnonzero(bits == 0).tolist())
    return len(lines), len(gone), b"\n".join(x for i, x in enumerate(lines) if i not in gone)


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep: str = "none"
) -> DataFrame:
    """(doc, text_hash, keep_bits) for each document that loses lines, as a table in the shared folder."""
    pack = F.udf(bitmap, T.BinaryType(), useArrow=True)
    out = None
    with scratch(lambda: out):
        lost = dropped_lines(line_rows(docs, id_col, text_col, min_chars), min_docs, keep)
        packed = lost.groupBy("doc", "text_hash").agg(F.collect_set("position").alias("positions")).select("doc", "text_hash", pack("positions").alias("keep_bits"))
        out = written(packed, "keep-bits")
    return out


def _with_bitmaps(docs: DataFrame, bits: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` and their bitmaps (null: every line stays), by id and text hash.

    Documents that the bit table rules out take no part in the join.
    """
    a, b, c, d, e, w, x = fresh(docs, "line_doc", "line_text_hash", "line_text_hash_own", "keep_bits", "line_doc_own", "filter_word", "filter_bits")

    def place(doc: Column, text_hash: Column) -> Column:
        return F.pmod(F.xxhash64(doc, text_hash), F.lit(FILTER_BITS))

    def one(at: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int"))

    at = place(F.col("doc"), F.col("text_hash"))
    # FILTER_BITS / 64 rows at most.
    table = bits.select(F.floor(at / 64).cast("long").alias(w), one(at % 64).alias(x)).groupBy(w).agg(F.bit_or(x).alias(x))
    keyed = docs.withColumns({e: number(docs, id_col), c: _text_hash(text_col)})
    at = place(col(e), col(c))
    marked = keyed.withColumn("_" + w, F.floor(at / 64).cast("long")).join(F.broadcast(table), F.col("_" + w) == F.col(w), "left")
    maybe = F.coalesce(col(x).bitwiseAND(one(at % 64)) != 0, F.lit(False))
    right = bits.select(F.col("doc").alias(a), F.col("text_hash").alias(b), F.col("keep_bits").alias(d))
    touched = marked.where(maybe).join(right, col(e).eqNullSafe(col(a)) & (col(c) == col(b)), "left")
    own = [col(n) for n in docs.columns]
    rest = marked.where(~maybe).select(*own, F.lit(None).cast("binary").alias(d))
    return touched.select(*own, col(d)).unionByName(rest), d


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep: str = "first"
) -> DataFrame:
    """``docs`` with the repeated lines gone from their texts; every row stays, with the same columns."""
    joined, bits = _with_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_docs, min_chars, keep), id_col, text_col)
    at, width = docs.columns.index(text_col), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            packed = batch.column(width).to_pylist()
            columns = batch.columns[:width]
            if any(packed):
                raw = texts(batch, at)
                columns[at] = pa.array([apply_bitmap(x, p)[2] if p else x for x, p in zip(raw, packed)], pa.binary()).cast(pa.string())
            yield columns

    return map_rows(joined, run, docs.schema)


def report(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256, by the policy that drops every occurrence."""
    import hashlib

    docs = docs.select("doc_id", "text")
    joined, _ = _with_bitmaps(docs, keep_bitmaps(docs, min_docs=min_docs), "doc_id", "text")
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            done = [apply_bitmap(x, p) for x, p in zip(texts(batch, 1), batch.column(2).to_pylist())]
            yield [
                batch.column(0),
                pa.array([x[0] for x in done], pa.int64()),
                pa.array([x[1] for x in done], pa.int64()),
                pa.array([hashlib.sha256(x[2]).hexdigest() for x in done], pa.string()),
            ]

    return map_rows(joined, run, schema)
