"""Helpers shared by the training-data operators.

Operators that need Python run as ``mapInArrow`` over whole rows: Arrow hands
over bounded record batches, texts are read as UTF-8 bytes, and nothing but the
current batch is held.
"""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts processed at a time inside a task, in bytes; longer single texts stand alone.
SLICE_BYTES = 2 << 20


def fresh(taken: DataFrame | list[str], *names: str) -> list[str]:
    """Column names like ``names`` that clash with none of ``taken`` (case-insensitively)."""
    seen = {c.lower() for c in (taken if isinstance(taken, list) else taken.columns)}
    out = []
    for name in names:
        while name.lower() in seen:
            name = f"_{name}"
        seen.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts(batch: pa.RecordBatch, i: int) -> list[bytes | None]:
    """Column ``i`` of a batch as UTF-8 bytes; None where null."""
    return batch.column(i).cast(pa.binary()).to_pylist()


def small_slices(batch: pa.RecordBatch, i: int) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of a batch that hold about SLICE_BYTES of column ``i`` each."""
    if batch.num_rows == 0:
        return
    total = batch.column(i).nbytes
    if total <= SLICE_BYTES:
        yield batch
        return
    sizes = [len(x or b"") for x in texts(batch, i)]
    start = held = 0
    for k, n in enumerate(sizes):
        if held and held + n > SLICE_BYTES:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += n
    yield batch.slice(start)


def release() -> None:
    """Hands a finished task's memory back, as a worker that waits for its next task keeps its pages otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def map_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` that goes by position: ``run`` gives lists of arrays, and columns may have any names."""
    names = [f"c{i}" for i in range(len(schema))]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrays in run(batches):
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        release()

    plain = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(names, schema)])
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(named, plain).toDF(*schema.fieldNames())


def append_columns(
    df: DataFrame,
    text_col: str,
    fields: list[T.StructField],
    make: Callable[[], Callable[[list[bytes | None]], list[pa.Array]]],
) -> DataFrame:
    """``df`` with further columns computed from ``text_col``, in Arrow batches.

    ``make()`` runs once in each task and returns the function that turns the
    texts of a batch into one Arrow array per field.
    """
    schema = T.StructType([*df.schema.fields, *fields])
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        f = make()
        for whole in batches:
            for batch in small_slices(whole, at):
                yield [*batch.columns, *f(texts(batch, at))]

    return map_rows(df, run, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or one set for tests.

    Only where the setting is absent (local mode) a temporary folder is chosen.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        at = spark.conf.get("spark.corvane.checkpoint.dir", None) or tempfile.mkdtemp(prefix="corvane-")
        spark.conf.set("spark.corvane.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again.

    This ends the lineage like a reliable checkpoint, but computes the rows once
    and keeps columns apart. The table stays until ``discard`` or until the folder
    is emptied, since plans that are still to run may read it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._corvane_path = path
    for held in _SCOPES.get():
        held.append(out)
    return out


#: The tables of each open scope; a thread has its own, so that none deletes what another still reads.
_SCOPES: contextvars.ContextVar[tuple[list[DataFrame], ...]] = contextvars.ContextVar("_SCOPES", default=())


@contextlib.contextmanager
def scratch(keep: Callable[[], DataFrame | None]) -> Iterator[None]:
    """Deletes, at its end, the tables that were ``written`` inside, but for the one that ``keep`` gives."""
    held: list[DataFrame] = []
    before = _SCOPES.set((*_SCOPES.get(), held))
    try:
        yield
    finally:
        _SCOPES.reset(before)
        kept = keep()
        for df in held:
            if df is not kept:
                discard(df)


def discard(df: DataFrame) -> None:
    """Deletes a table that ``written`` made and no plan needs any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._corvane_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learnable(id_col: str) -> Column:
    """Rows that may be learnt from: a known id that is not held out."""
    return F.coalesce(F.crc32(col(id_col).cast("string")) % 4 != 2, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def number(df: DataFrame, id_col: str) -> Column:
    """An id as a 64-bit number: itself where it is an integer, else a hash; null stays null."""
    if isinstance(df.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return col(id_col).cast("long")
    return F.when(col(id_col).isNotNull(), F.xxhash64(col(id_col)))


#: Keys that are taken as hot, at most, and rows of a key that is never hot.
HOT_KEYS, COLD_ROWS = 10_000, 256


def join_skewed(left: DataFrame, right: DataFrame, key: str, right_key: str, count: str, total: int) -> DataFrame:
    """Inner join where ``right`` has every key once, and in ``count`` its number of rows on the left.

    Keys that hold more than one in HOT_KEYS of the ``total`` rows of ``left``, of
    which there are HOT_KEYS at most, are broadcast, so that the rows of a hot key
    stay where they are. The others are shuffled, and none is hot. ``count`` is
    not among the columns of the result.
    """
    limit = max(COLD_ROWS, total // HOT_KEYS)
    right = written(right, "keys")
    hot = right.where(F.col(count) > limit).drop(count)
    if not right.where(F.col(count) > limit).limit(1).count():
        return left.join(right.drop(count), F.col(key) == F.col(right_key))
    cold = right.where(F.col(count) <= limit).drop(count)
    near = left.join(F.broadcast(hot), F.col(key) == F.col(right_key))
    far = left.join(F.broadcast(hot.select(F.col(right_key).alias("_hot_key"))), F.col(key) == F.col("_hot_key"), "left_anti")
    return near.unionByName(far.join(cold, F.col(key) == F.col(right_key)))


def in_pairs(rows: DataFrame, keys: list[str], by: str, limit: int) -> DataFrame:
    """``rows`` with two columns i and j more, such that no (keys, i, j) has more than about twice ``limit`` rows.

    A group of more than ``limit`` rows is cut into blocks by a hash of ``by``,
    and its rows go to every pair of blocks that has theirs, so that any two rows
    of a group meet. Blocks count from 1; rows of other groups have i and j zero,
    which tells that their group is whole. Any two rows of a
    group with equal ``by`` fall into one block.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > limit)
    sizes = written(sizes.select(*(F.col(k).alias(f"_{x}") for x, k in enumerate(keys)), F.ceil(F.col("_n") / limit).cast("int").alias("_blocks")), "sizes")
    if not (groups := sizes.count()):
        return rows.withColumns({"i": F.lit(0), "j": F.lit(0)})
    if groups <= HOT_KEYS:
        sizes = F.broadcast(sizes)
    on = [F.col(k) == F.col(f"_{x}") for x, k in enumerate(keys)]
    large = rows.join(sizes, on)
    own = F.pmod(F.xxhash64(by), F.col("_blocks")).cast("int") + 1
    paired = large.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(1), F.col("_blocks"))))
    paired = paired.withColumns({"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other")}).select(*rows.columns, "i", "j")
    small = rows.join(sizes, on, "left_anti").withColumns({"i": F.lit(0), "j": F.lit(0)})
    return small.unionByName(paired)
