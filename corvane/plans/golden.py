"""Queries over worked examples: every order gets one by its key, and the oracle has what each must give, written out by hand."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.plans.carrier import quote
from corvane.registry import register

Cell = str | int | float | bool | None


def _sql(value: Cell) -> str:
    if value is None:
        return "NULL"
    return quote(value) if isinstance(value, str) else str(value)


def worked(name: str, inputs: Sequence[str], outputs: Sequence[str], function: Callable[..., dict[str, Column] | Column], cases: Sequence[tuple[Cell, ...]]) -> None:
    """Registers ``name``: ``function`` of the input columns gives the output columns, or a struct that has them.

    A case has the inputs' values, then the outputs'.
    """
    width = len(inputs)
    given = [c[:width] for c in cases]
    values = ", ".join(f"({i}, {', '.join(map(_sql, c[width:]))})" for i, c in enumerate(cases))
    sql = f"SELECT o_orderkey, {', '.join(outputs)} FROM orders JOIN (VALUES {values}) AS e(i, {', '.join(outputs)}) ON o_orderkey % {len(cases)} = i"

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = F.array(*(F.struct(*(F.lit(v).cast("string").alias(n) for n, v in zip(inputs, c))) for c in given))
        at = F.expr(f"cast(o_orderkey % {len(cases)} as int)")
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.get(texts, at).alias("x"))
        plain = orders.select("o_orderkey", *(F.col("x").getField(n).alias(n) for n in inputs))
        found = function(*(F.col(n) for n in inputs))
        if isinstance(found, Column):  # once for all its fields
            return plain.select("o_orderkey", found.alias("_found")).select("o_orderkey", *(F.col("_found").getField(n).alias(n) for n in outputs))
        return plain.select("o_orderkey", *(found[n].alias(n) for n in outputs))

    query.__name__ = name
    query.__doc__ = f"Worked examples of {', '.join(outputs)}."
    register(name, sql)(query)
