"""Token counts by a scan for separators in flat, unindexed token files.

A flat file is nothing but token ids, one document after another, each closed by
an end-of-document id. It is read in byte ranges that know nothing of documents,
nor of where an id begins. Ranges come from Spark's text source, which cuts a file
of any size on any store at the line feeds that its bytes happen to hold; put back
between the lines, they give the range's bytes. Within a range the end ids are
found block by block with one vectorised comparison, once for each place at which
the first whole id may begin. A range gives its count of ends, the tokens before
its first end and after its last, the bytes of ids cut by its edges, and the
lengths between ends. A prefix scan over the ranges of a file, of which there is
one for some hundred MB, settles where ids begin, puts cut ids together, carries
open documents across the edges and numbers the documents; the lengths never take
part in it, and are numbered by a join with what it found for their range.

Edge cases: an empty file has no document. An empty document is an end id alone
and has 0 tokens. Tokens after a file's last end id are an unclosed document,
reported with ``closed`` false; a file without any end id is one of those. A last
line feed that fills no id is the end of a text file and nothing else; other bytes
that don't fill a last id raise an error. A file without any line feed is one
range, and must fit into a task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import col, map_rows, shared_dir, small_slices, texts, written
from corvane.llm.packing import encoder, vocabulary_path

#: The end-of-document id of the vocabulary, and the type of the ids in a file.
END_ID = 49407
DTYPE = "<u2"
#: Bytes that are searched at a time.
BLOCK_BYTES = 1 << 20

#: What a range has for each ``phase``, the number of its bytes before the first whole id, and the lengths of its inner documents in chunks.
_FOUND = T.StructType(
    [
        T.StructField("file", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("phase", T.IntegerType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_ends", T.LongType()),
        T.StructField("head", T.LongType()),
        T.StructField("tail", T.LongType()),
        T.StructField("first_bytes", T.BinaryType()),
        T.StructField("last_bytes", T.BinaryType()),
        #: The place of the first of these lengths in the range; null in a row without lengths, which has all the other columns.
        T.StructField("at", T.LongType()),
        T.StructField("lengths", T.ArrayType(T.LongType())),
    ]
)


def _file():
    return F.xxhash64(F.col("_metadata.file_path"))


class _Phase:
    """One reading of a range: the ids that begin ``phase`` bytes after its first byte."""

    def __init__(self, phase: int, dtype: str, end_id: int) -> None:
        self.phase, self.dtype, self.end_id = phase, dtype, end_id
        self.skip, self.held = phase, b""
        self.n_ends = self.head = self.tail = 0

    def feed(self, block: bytes) -> np.ndarray:
        """Lengths of the documents that begin after the range's first end and end in ``block``."""
        if self.skip:
            self.skip, block = max(self.skip - len(block), 0), block[self.skip :]
        data = self.held + block
        whole = len(data) - len(data) % np.dtype(self.dtype).itemsize
        ids, self.held = np.frombuffer(data[:whole], dtype=self.dtype), data[whole:]
        ends = np.flatnonzero(ids == self.end_id)
        if not len(ends):
            self.tail += len(ids)
            return ends
        lengths = np.diff(ends, prepend=-1) - 1
        lengths[0] += self.tail
        if not self.n_ends:
            self.head, lengths = int(lengths[0]), lengths[1:]
        self.n_ends += len(ends)
        self.tail = len(ids) - 1 - int(ends[-1])
        return lengths


def ranges(spark: SparkSession, path: str, end_id: int = END_ID, dtype: str = DTYPE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """What every byte range of the flat files under ``path`` holds, for each phase."""
    width = np.dtype(dtype).itemsize
    lines = spark.read.option("lineSep", "\n").text(path).select(_file(), F.col("_metadata.file_block_start"), F.col("value").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        now, held, total = None, b"", 0
        phases: list[_Phase] = []

        def row(phase: _Phase, at: int | None, lengths: np.ndarray | None) -> list[pa.Array]:
            rest = [None] * 6 if lengths is not None else [total, phase.n_ends, phase.head, phase.tail, first[: phase.phase], phase.held]
            values = [*now, phase.phase, *rest, at, lengths]
            return [pa.array([v], t) for v, t in zip(values, _ARROW)]

        def feed(block: bytes) -> Iterator[list[pa.Array]]:
            for phase in phases:
                at = max(phase.n_ends - 1, 0)
                if len(lengths := phase.feed(block)):
                    yield row(phase, at, lengths)

        def finish() -> Iterator[list[pa.Array]]:
            nonlocal held
            if now is not None:
                yield from feed(held)
                held = b""
                for phase in phases:
                    yield row(phase, None, None)

        first = b""
        for batch in batches:
            names, starts = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            edges = [0, *(np.flatnonzero((names[1:] != names[:-1]) | (starts[1:] != starts[:-1])) + 1).tolist(), len(names)]
            for s, e in zip(edges, edges[1:]):
                if s == e:
                    continue
                piece = b"\n".join(batch.column(2).slice(s, e - s).to_pylist())
                if (key := (int(names[s]), int(starts[s]))) != now:
                    yield from finish()
                    now, total, first = key, 0, b""
                    phases = [_Phase(p, dtype, end_id) for p in range(width)]
                else:
                    piece = b"\n" + piece
                total += len(piece)
                first = (first + piece[:width])[:width]
                held += piece
                if len(held) >= block_bytes:
                    for at in range(0, len(held), block_bytes):
                        yield from feed(held[at : at + block_bytes])
                    held = b""
        yield from finish()

    return map_rows(lines, run, _FOUND)


_ARROW = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 2, pa.int64(), pa.list_(pa.int64())]

_CARRIED = T.StructType(
    [
        T.StructField("file", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("phase", T.IntegerType()),
        #: Number of the first document that ends inside the range after another one.
        T.StructField("base", T.LongType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("closed", T.BooleanType()),
    ]
)


def _scan(end_id: int, dtype: str):
    """The prefix scan over one file's ranges: a row for each range, and one for each document that an edge cuts."""
    width = np.dtype(dtype).itemsize
    end = np.array([end_id], dtype=dtype).tobytes()

    def run(key, found):
        out = []
        open_, ordinal, cut, offset = 0, 0, b"", 0
        size = int(found["size"].iloc[0])
        by_start = {}
        for r in found.itertuples(index=False):
            by_start.setdefault(r.start, {})[r.phase] = r
        starts = sorted(by_start)

        def take(raw: bytes) -> None:
            """Bytes at an edge, between the whole ids of ranges."""
            nonlocal cut, open_, ordinal
            cut += raw
            while len(cut) >= width:
                one, cut = cut[:width], cut[width:]
                if one == end:
                    out.append((key, None, None, None, ordinal, open_, True))
                    open_, ordinal = 0, ordinal + 1
                else:
                    open_ += 1

        for k, start in enumerate(starts):
            need = -len(cut) % width
            r = by_start[start][need]
            offset += r.n_bytes
            if r.n_bytes < need:
                take(r.first_bytes)
            else:
                take(r.first_bytes)
                if r.n_ends:
                    out.append((key, None, None, None, ordinal, open_ + r.head, True))
                    out.append((key, start, need, ordinal + 1, None, None, None))
                    open_, ordinal = r.tail, ordinal + r.n_ends
                else:
                    open_ += r.tail
                take(r.last_bytes)
            # The line feed after a range's last line belongs to no range; after the last range there may be none.
            if k + 1 < len(starts) or offset < size:
                if k + 1 == len(starts) and size % width == 1 and not cut and width > 1:
                    break
                take(b"\n")
                offset += 1
        if cut:
            raise ValueError(f"a file of {size} bytes doesn't hold whole ids of {width} bytes")
        if open_:
            out.append((key, None, None, None, ordinal, open_, False))
        return out

    return run


def documents(spark: SparkSession, path: str, end_id: int = END_ID, dtype: str = DTYPE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document of the flat files under ``path``: file, ordinal (from 0), n_tokens without the end id, closed."""
    import pandas as pd

    found = written(ranges(spark, path, end_id, dtype, block_bytes), "ranges")
    files = spark.read.format("binaryFile").load(path).select(_file().alias("key"), F.col("_metadata.file_path").alias("path"), F.col("length").alias("size"))
    # One row for each file and range, whatever they hold.
    summaries = found.where("at is null").drop("at", "lengths").join(files.select("key", "size"), F.col("file") == F.col("key")).drop("key")
    scan, names = _scan(end_id, dtype), _CARRIED.fieldNames()

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(scan(int(key[0]), frame), columns=names)
        return out.astype({n: "Int64" for n in names[:-1]} | {"phase": "Int32", "closed": "boolean"})

    carried = written(summaries.groupBy("file").applyInPandas(run, _CARRIED), "carried")
    bases = carried.where("base is not null").select(F.col("file").alias("f"), F.col("start").alias("s"), F.col("phase").alias("p"), "base")
    on = (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")) & (F.col("phase") == F.col("p"))
    inner = found.where("at is not null").join(bases, on).select("file", (F.col("base") + F.col("at")).alias("first"), F.posexplode("lengths").alias("i", "n_tokens"))
    inner = inner.select("file", (F.col("first") + F.col("i")).alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    every = inner.unionByName(carried.where("base is null").select("file", "ordinal", "n_tokens", "closed"))
    return every.join(files, F.col("file") == F.col("key")).select(F.col("path").alias("file"), "ordinal", "n_tokens", "closed")


def totals(spark: SparkSession, path: str, end_id: int = END_ID, dtype: str = DTYPE) -> DataFrame:
    """Per file: file, n_documents (closed ones), n_tokens."""
    found = documents(spark, path, end_id, dtype)
    return found.groupBy("file").agg(F.count_if("closed").alias("n_documents"), F.sum("n_tokens").alias("n_tokens"))


def write_flat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, vocabulary: str | None = None) -> tuple[str, DataFrame]:
    """Tokenises ``docs`` into flat files in the shared folder, one for each partition; gives their path, and a manifest (part, ordinal, doc_id).

    Spark's text sink writes the files, on any store: it puts a line feed after
    every row, so the stream is cut at its line feeds, and where it doesn't end
    with one the file has one byte more.
    """
    path = vocabulary or vocabulary_path()
    schema = T.StructType([T.StructField("value", T.BinaryType()), T.StructField("kind", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        # The end id must stand for nothing but an end, whatever strings a text holds.
        encode, end = encoder(path, specials=False).encode, np.array([end_id], dtype=DTYPE).tobytes()
        held = b""

        def out(rows: list[bytes], kind: str) -> list[pa.Array]:
            return [pa.array(rows, pa.binary()), pa.array([kind] * len(rows), pa.string())]

        for whole in batches:
            for batch in small_slices(whole, 1):
                stream = b"".join(np.frombuffer(raw, dtype="<u4").astype(DTYPE).tobytes() + end for raw in encode(texts(batch, 1)))
                *rows, held = (held + stream).split(b"\n")
                yield out(rows, "tokens")
                yield out(texts(batch, 0), "documents")
        if held:
            yield out([held], "tokens")

    spark = docs.sparkSession
    at = f"{shared_dir(spark)}/flat-{uuid.uuid4().hex}"
    rows = map_rows(docs.select(F.to_json(F.struct(col(id_col).alias("doc_id"))), col(text_col)), run, schema)
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")  # both kinds are written as they come, without a sort
    try:
        rows.select(F.col("value").cast("string"), "kind").write.partitionBy("kind").text(at)
    finally:
        spark.conf.set(key, before)
    for name in ("tokens", "documents"):  # there are none for an empty table
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{at}/kind={name}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    kind = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)])
    lines = spark.read.text(f"{at}/kind=documents").select(_part(F.col("_metadata.file_path")).alias("part"), F.col("_metadata.file_block_start").alias("start"), "value")
    return f"{at}/kind=tokens", _numbered(lines, kind)


def _part(path):
    """The number of the task that wrote a file."""
    return F.regexp_extract(path, r"part-(\d+)-[^/]*$", 1).cast("long")


def _numbered(lines: DataFrame, kind: T.StructType) -> DataFrame:
    """(part, ordinal, doc_id) of the manifest's lines, by their place in their file."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("part", "start", "i")] + [T.StructField("value", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        now, n = None, 0
        for batch in batches:
            parts, starts = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            place = np.empty(len(parts), dtype=np.int64)
            for k, key in enumerate(zip(parts.tolist(), starts.tolist())):
                now, n = key, n + 1 if key == now else 0
                place[k] = n
            yield [batch.column(0), batch.column(1), pa.array(place), batch.column(2)]

    rows = written(map_rows(lines, run, schema), "manifest")
    # Lines before each range of a file: one row for each range.
    sizes = rows.groupBy("part", "start").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    before = Window.partitionBy("part").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("part").alias("p"), F.col("start").alias("s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    joined = rows.join(bases, (F.col("part") == F.col("p")) & (F.col("start") == F.col("s")))
    return joined.select("part", (F.col("base") + F.col("i")).alias("ordinal"), F.from_json("value", kind)["doc_id"].alias("doc_id"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, file, ordinal, n_tokens, as a scan of the flat files finds them."""
    path, manifest = write_flat(docs)
    found = documents(docs.sparkSession, path).select("file", F.col("ordinal").alias("o"), "n_tokens")
    joined = manifest.join(found.withColumn("q", _part(F.col("file"))), (F.col("part") == F.col("q")) & (F.col("ordinal") == F.col("o")))
    return joined.select("doc_id", F.format_string("part-%06d", "part").alias("file"), "ordinal", "n_tokens")
