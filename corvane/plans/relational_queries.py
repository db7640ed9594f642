"""Queries of the joins, windows, log replays, clustering and model calls, with SQL oracles where there are any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators import clustering, model_call, relational
from corvane.plans.text_queries import ABSTRACT, ARM
from corvane.registry import register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register(
    "left_join_lastwins",
    """SELECT c.c_custkey, o.o_orderstatus AS status, o.o_totalprice AS price FROM customer c
LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1) o ON c.c_custkey = o.o_custkey""",
)
def left_join_lastwins(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    return relational.left_join_last(_read(spark, sf_dir, "customer").select("c_custkey"), right, "c_custkey", "o_orderkey", ["status", "price"])


_VALUE = "case when o_orderkey % 3 = 0 then o_orderpriority else '' end"


@register(
    "first_filled_broadcast",
    f"""WITH a AS (SELECT o_orderkey, o_custkey, {_VALUE} AS v FROM orders),
s AS (SELECT o_custkey, arg_min(v, o_orderkey) AS f FROM a WHERE v <> '' GROUP BY 1)
SELECT o_orderkey, coalesce(nullif(v, ''), f, '') AS filled, case when v <> '' then 'own' when f is not null then 'record_broadcast' else '' end AS status FROM a LEFT JOIN s USING (o_custkey)""",
)
def first_filled_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.expr(_VALUE).alias("v"))
    return relational.fill_from_group(rows, "v", "o_custkey", "o_orderkey").select("o_orderkey", "filled", "status")


@register("pending_antijoin", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def pending_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return relational.pending(_read(spark, sf_dir, "customer").select("c_custkey"), done, "c_custkey")


@register("semi_selected", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return relational.selected(_read(spark, sf_dir, "customer").select("c_custkey"), wanted, "c_custkey")


@register(
    "sheet_promotion",
    "SELECT o_orderkey, case when bool_or(o_totalprice > 200000) OVER (PARTITION BY o_custkey) then 'Results' else 'Other' end AS sheet FROM orders",
)
def sheet_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.promoted(_read(spark, sf_dir, "orders"), "o_custkey", F.col("o_totalprice") > 200000).select("o_orderkey", "sheet")


@register("serial_numbers", "SELECT o_orderkey, 'S2-orders-' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS serial_id FROM orders")
def serial_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.serials(_read(spark, sf_dir, "orders"), "S2", "orders", "o_custkey", [F.col("o_orderkey")]).select("o_orderkey", "serial_id")


@register("batch_sizes", "SELECT CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 64 AS BIGINT) AS batch, count(*) AS n FROM customer GROUP BY ALL".replace("SELECT", "SELECT batch, count(*) AS n FROM (SELECT", 1).replace(", count(*) AS n FROM customer GROUP BY ALL", " FROM customer) GROUP BY 1"))
def batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relational.batches(_read(spark, sf_dir, "customer").select("c_custkey"), F.col("c_custkey"), 64)
    return rows.groupBy("batch").agg(F.count("*").alias("n"))


_TYPE = "case event_type when 'click' then 'row' when 'view' then 'usage' when 'purchase' then 'no_row' else 'meta' end"


@register(
    "resume_log",
    f"SELECT count(*) FILTER (WHERE t = 'row') AS n_rows, count(*) FILTER (WHERE t = 'usage') AS n_calls, count(DISTINCT case when t in ('row', 'no_row') then user_id end) AS n_complete FROM (SELECT *, {_TYPE} AS t FROM events)",
)
def resume_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _read(spark, sf_dir, "events").select(F.expr(_TYPE).alias("type"), F.col("event_id").alias("seq"), F.col("user_id").alias("record_id"))
    return relational.replay(log)


@register("log_lastwrite", "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1")
def log_lastwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.last_write(_read(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), "user_id", "event_id")


@register("tfidf_clusters")
def tfidf_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and top terms of each cluster of arm texts."""
    arms = _read(spark, sf_dir, "orders").select("o_orderkey", ARM.column().alias("text"))
    return clustering.clusters(arms, "text", 8)


_WORD = "regexp_extract(t, '[0-9A-Za-z_]+', 0)"


@register(
    "model_call_passes",
    f"""SELECT o_orderkey AS record_id, 1 AS pass, '{{"number": "' || regexp_extract(t, '[0-9]+', 0) || '", "word": "' || {_WORD} || '"}}' AS answer
FROM (SELECT o_orderkey, {ABSTRACT.sql()} AS t FROM orders)""",
)
def model_call_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every abstract through the rule-based stand-in for a model, in passes over what is still open."""
    texts = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record_id"), ABSTRACT.column().alias("text"))
    return model_call.extract_in_passes(texts, model_call.RuleBackend())
