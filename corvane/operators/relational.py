"""Joins, windows and log replays that the stages share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_write(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by ``order``."""
    kept = df.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("_row"))
    return kept.select("_row.*")


def left_join_last(left: DataFrame, right: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """``left`` with the values of the last ``right`` row of its key; rows of ``left`` never multiply."""
    last = last_write(right.select(key, order, *values), key, order).select(F.col(key).alias("_k"), *values)
    return left.join(last, F.col(key) == F.col("_k"), "left").drop("_k")


def first_filled(df: DataFrame, value: str, group: str, order: str) -> DataFrame:
    """(group, shared): the first non-empty value of each group. A partial minimum by group: no group is brought together."""
    own = F.nullif(F.trim(F.col(value)), F.lit(""))
    return df.where(own.isNotNull()).groupBy(group).agg(F.min_by(own, F.col(order)).alias("shared"))


def fill_from_group(df: DataFrame, value: str, group: str, order: str) -> DataFrame:
    """Empty values filled with the group's first non-empty one, and where each came from."""
    own = F.nullif(F.trim(F.col(value)), F.lit(""))
    shared = first_filled(df, value, group, order).withColumnRenamed(group, "_group")
    joined = df.join(shared, F.col(group) == F.col("_group"), "left").drop("_group")
    status = F.when(own.isNotNull(), "own").when(F.col("shared").isNotNull(), "record_broadcast").otherwise("")
    return joined.withColumns({"filled": F.coalesce(own, "shared", F.lit("")), "status": status}).drop("shared")


def pending(every: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done yet."""
    return every.join(done.select(F.col(key).alias("_done")).distinct(), F.col(key) == F.col("_done"), "left_anti")


def selected(every: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is wanted."""
    return every.join(wanted.select(F.col(key).alias("_wanted")).distinct(), F.col(key) == F.col("_wanted"), "left_semi")


def promoted(df: DataFrame, key: str, is_result: Column) -> DataFrame:
    """Rows with their sheet: results, and others whose key has a result, are ``Results``; the rest ``Other``."""
    good = df.where(is_result & (F.trim(F.col(key).cast("string")) != "")).select(F.col(key).alias("_k")).distinct()
    joined = df.join(good, F.col(key) == F.col("_k"), "left")
    return joined.withColumn("sheet", F.when(is_result | F.col("_k").isNotNull(), "Results").otherwise("Other")).drop("_k")


def serials(df: DataFrame, prefix: str, label: str, group: str, order: list[Column]) -> DataFrame:
    """Serial ids ``prefix-label-n``, counted from 1 in each group."""
    n = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("serial_id", F.concat_ws("-", F.lit(prefix), F.lit(label), n.cast("string")))


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Rows with their place from 0 in an order over the whole table.

    This is a range sort and a prefix sum over partition counts, not a single task.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    counts = ordered.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row for each partition.
    base = counts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    at = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_base")
    return ordered.join(F.broadcast(base), F.col("_part") == F.col("_p")).withColumn(name, at).drop("_part", "_at", "_p", "_base")


def batches(df: DataFrame, order: Column, size: int) -> DataFrame:
    """Rows with their batch number, ``size`` rows in order to a batch."""
    return numbered(df, "_place", order).withColumn("batch", F.floor(F.col("_place") / size)).drop("_place")


def batch_members(df: DataFrame, key: str, order: Column, size: int) -> DataFrame:
    """(batch, ids): the ids of each batch, in order; ``size`` ids at most."""
    placed = numbered(df.select(key), "_place", order).withColumn("batch", F.floor(F.col("_place") / size))
    pairs = placed.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("_place", key))).alias("_ids"))
    return pairs.select("batch", F.transform("_ids", lambda x: x[key]).alias("ids"))


def sorted_serials(df: DataFrame, prefix: str, label: str, *order: Column) -> DataFrame:
    """Serial ids ``prefix-label-n`` over the whole table, from 1 in its order."""
    return numbered(df, "_place", *order).withColumn("serial_id", F.concat_ws("-", F.lit(prefix), F.lit(label), (F.col("_place") + 1).cast("string"))).drop("_place")


def record_order(record_id: Column) -> Column:
    """Sort key of a record id: its number, or a great one for what is none."""
    return F.coalesce(record_id.try_cast("long"), F.lit(10**12).cast("long"))


def prefixed_id(prefix: str, label: Column, serial: Column) -> Column:
    return F.concat_ws("-", F.lit(prefix), label, serial.cast("string"))


def parsed_id(c: Column, prefix: str) -> Column:
    """(label, serial) of an id ``prefix-label-n``; null for what is none."""
    pattern = rf"^{prefix}-(.+)-(\d+)$"
    return F.when(
        F.trim(c).rlike(pattern),
        F.struct(F.regexp_extract(F.trim(c), pattern, 1).alias("label"), F.regexp_extract(F.trim(c), pattern, 2).cast("long").alias("serial")),
    )


def source_label(path: Column) -> Column:
    """A file's name as a label: letters, digits, dots, dashes and underlines, 80 characters at most."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/\\]+)$", 1), r"\.[^.]*$", "")
    label = F.regexp_replace(F.regexp_replace(F.trim(stem), r"[^\p{L}\p{N}._-]+", "_"), r"^[._-]+|[._-]+$", "")
    return F.coalesce(F.nullif(F.substring(label, 1, 80), F.lit("")), F.lit("source"))


def matched(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``left`` that ``right`` has a row for, with its columns, in the order of ``left``."""
    own = right.select(F.col(key).alias("_key"), *(c for c in right.columns if c != key))
    return left.join(own, F.col(key) == F.col("_key")).drop("_key").orderBy(order)


def with_fallback(left: DataFrame, right: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """Every row of ``left`` with the values of its ``right`` row, or with fallback values."""
    own = right.select(F.col(key).alias("_key"), *(F.col(v).alias(f"_{v}") for v in values))
    joined = left.join(own, F.col(key) == F.col("_key"), "left")
    return joined.select(*left.columns, *(F.when(F.col("_key").isNotNull(), F.col(f"_{v}")).otherwise(c).alias(v) for v, c in values.items()))


def backfilled(left: DataFrame, right: DataFrame, key: str, values: list[str]) -> DataFrame:
    """``left`` with blank values filled from the ``right`` row of the same key."""
    own = right.select(F.col(key).alias("_key"), *(F.col(v).alias(f"_{v}") for v in values))
    joined = left.join(own, F.col(key) == F.col("_key"), "left")
    filled = {v: F.coalesce(F.nullif(F.trim(F.col(v)), F.lit("")), F.col(f"_{v}"), F.lit("")) for v in values}
    return joined.select(*(filled.get(c, F.col(c)).alias(c) for c in left.columns))


def with_columns(df: DataFrame, names: list[str], default: str = "") -> DataFrame:
    """``df`` with exactly these columns; those that it lacks have the default."""
    return df.select(*((F.col(f"`{n}`") if n in df.columns else F.lit(default)).alias(n) for n in names))


def without_blank_rows(df: DataFrame) -> DataFrame:
    """Rows in which any cell is filled."""
    filled = [F.coalesce(F.trim(F.col(f"`{c}`").cast("string")) != "", F.lit(False)) for c in df.columns]
    return df.where(F.greatest(*filled)) if len(filled) > 1 else df.where(filled[0])


def find_column(columns: list[str], exact: str, prefix: str | None = None) -> str | None:
    """A column by its name, else the first that begins with ``prefix``."""
    if exact in columns:
        return exact
    return next((c for c in columns if prefix and c.startswith(prefix)), None)


def completed(log: DataFrame, by_usage: bool = False) -> DataFrame:
    """(record_id) of the records that a checkpoint log calls complete, by their rows and by notes that they have none; ``by_usage``: also by the ids of its calls."""
    own = log.where(F.col("type").isin("row", "no_row", "no_row_resolution")).select("record_id")
    if by_usage and "completed_record_ids" in log.columns:
        own = own.unionByName(log.where("type = 'usage'").select(F.explode("completed_record_ids").alias("record_id")))
    return own.where("record_id is not null").distinct()


def replay(log: DataFrame, by_usage: bool = False) -> DataFrame:
    """State of a checkpoint log with columns type, seq, record_id: rows, calls and distinct records that are complete."""
    counts = log.agg(F.count_if(F.col("type") == "row").alias("n_rows"), F.count_if(F.col("type") == "usage").alias("n_calls"))
    return counts.crossJoin(completed(log, by_usage).agg(F.count("*").alias("n_complete")))  # one row each


def usage_totals(log: DataFrame) -> DataFrame:
    """One row: tokens summed over the calls of a checkpoint log."""
    data = F.col("data")
    return log.where("type = 'usage'").agg(
        *(F.coalesce(F.sum(F.try_element_at(data, F.lit(k)).try_cast("long")), F.lit(0)).alias(k) for k in ("prompt_tokens", "completion_tokens", "total_tokens"))
    )


def rows_of_log(log: DataFrame, fields: list[str], last_by: str | None = None) -> DataFrame:
    """The rows of a checkpoint log as columns, in the log's order by ``seq``; ``last_by``: only the last one of each id, blank ids dropped."""
    cells = [F.coalesce(F.try_element_at(F.col("data"), F.lit(n)), F.lit("")).alias(n) for n in fields]
    found = log.where("type = 'row'").select("seq", *cells)
    return found if last_by is None else last_write(found.where(F.trim(F.col(f"`{last_by}`")) != ""), last_by, "seq")


def gap(asked: DataFrame, covered: DataFrame, key: str = "record_id") -> DataFrame:
    """Ids that were asked for and not covered, each once."""
    return pending(asked.select(key).distinct(), covered, key)
