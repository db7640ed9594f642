"""Queries of the analytic operators, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import extract, standard, tables
from corvane.operators import analytics
from corvane.plans.carrier import Carrier, Number, Pick, case, hits
from corvane.plans.text_queries import ABSTRACT
from corvane.registry import register

INDICATION = Carrier(
    Pick("o_orderkey", ["Major depressive disorder", "treatment-resistant depression", "Postpartum anxiety", "Bipolar", "insomnia", "healthy volunteers", "Chronic pain", "HIV", "alcohol use"]),
    Pick("o_custkey", ["", " || anxiety", " || PTSD", " with cancer", " || dementia and diabetes"]),
)
ETHNICITY = Carrier(
    Number("o_orderkey % 80 + 5"),
    Pick("o_orderkey", ["% White", "% Black", "% Asian", "% Hispanic"]),
    Pick("o_custkey", ["", " + Black", " || 10% Latino", " + Pacific Islander + mixed", "; indigenous"]),
)
OCCUPATION = Carrier(Pick("o_orderkey", ["University students", "Nurses", "factory workers", "Farmers", "teachers and nurses"]))

_DISEASES = hits("lower(t)", tables.DISEASES)
_LABELLED = f"""labelled AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, case when len(h) = 0 then ['{tables.UNCLASSIFIED}'] else h end AS labels
FROM (SELECT *, {_DISEASES} AS h FROM (SELECT *, {INDICATION.sql()} AS t FROM orders)))"""


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


for _name, _table, _column in (
    ("freq_order_priority", "orders", "o_orderpriority"),
    ("freq_part_type", "part", "p_type"),
    ("freq_event_type", "events", "event_type"),
    ("freq_doc_lang", "documents", "lang"),
):

    @register(
        _name,
        f"""SELECT coalesce(nullif(trim({_column}), ''), '(Missing)') AS value, count(*) AS frequency,
round(count(*) / sum(count(*)) OVER (), 6) AS share FROM {_table} GROUP BY 1""",
    )
    def _frequency(spark: SparkSession, sf_dir: str, table: str = _table, column: str = _column) -> DataFrame:
        return _rounded(analytics.frequency(_read(spark, sf_dir, table), F.col(column)), "share")


_LIMITS = [50, 200, 500, 2000]
_SIZE = "floor(o_totalprice / 100)"


@register(
    "size_thresholds",
    f"SELECT '<= ' || t AS threshold, count(*) FILTER (WHERE {_SIZE} <= t) AS n, round(count(*) FILTER (WHERE {_SIZE} <= t) / count(*), 6) AS share FROM orders, (SELECT unnest({_LIMITS}) AS t) GROUP BY t",
)
def size_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.thresholds(_read(spark, sf_dir, "orders"), F.expr(_SIZE), _LIMITS), "share")


@register(
    "size_bands",
    f"""SELECT b.band, count(o_orderkey) AS n FROM (VALUES ('0-50', -1, 50), ('51-200', 50, 200), ('201-500', 200, 500), ('501-2000', 500, 2000), ('> 2000', 2000, 1e15)) b(band, lo, hi)
LEFT JOIN orders ON {_SIZE} > lo AND {_SIZE} <= hi GROUP BY 1""",
)
def size_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.size_bands(_read(spark, sf_dir, "orders"), F.expr(_SIZE), _LIMITS)


@register(
    "size_summary",
    f"SELECT count(*) AS n, round(avg(x), 6) AS mean, round(median(x), 6) AS median, round(stddev_samp(x), 6) AS sd, min(x) AS least, max(x) AS most FROM (SELECT CAST({_SIZE} AS DOUBLE) AS x FROM orders)",
)
def size_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.summary(_read(spark, sf_dir, "orders"), F.expr(_SIZE)), "mean", "median", "sd")


@register(
    "size_hist_fixed",
    f"""SELECT CAST(b AS INTEGER) AS bin, b * 30.0 AS start, count(x) AS n FROM range(100) r(b)
LEFT JOIN (SELECT {_SIZE} AS x FROM orders WHERE {_SIZE} BETWEEN 0 AND 3000) ON least(floor(x / 30), 99) = b GROUP BY 1, 2""",
)
def size_hist_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.fixed_histogram(_read(spark, sf_dir, "orders"), F.expr(_SIZE), 0.0, 3000.0, 100)


@register(
    "size_hist_log",
    f"""WITH x AS (SELECT CAST({_SIZE} AS DOUBLE) AS x FROM orders WHERE {_SIZE} > 0), m AS (SELECT log10(greatest(1, min(x))) AS a, log10(max(x)) AS b FROM x)
SELECT CAST(least(floor((log10(x) - a) / (b - a) * 44), 43) AS INTEGER) AS bin, count(*) AS n FROM x, m GROUP BY 1""",
)
def size_hist_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.log_histogram(_read(spark, sf_dir, "orders"), F.expr(_SIZE), 44)


@register(
    "followup_hist_p99",
    """WITH x AS (SELECT CAST(l_quantity AS DOUBLE) AS x FROM lineitem), q AS (SELECT quantile_cont(x, 0.5) AS m, quantile_cont(x, 0.75) AS u, quantile_cont(x, 0.99) AS p FROM x),
k AS (SELECT x, m, u FROM x, q WHERE x <= p), e AS (SELECT min(x) AS a, max(x) AS b FROM k)
SELECT CAST(least(floor((x - a) / (b - a) * 40), 39) AS INTEGER) AS bin, count(*) AS n, any_value(m) AS median, any_value(u) AS upper_quartile FROM k, e GROUP BY 1""",
)
def followup_hist_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.upto_percentile_histogram(_read(spark, sf_dir, "lineitem"), F.col("l_quantity"), 0.99, 40)


_CROSS = """WITH p AS (SELECT o_orderpriority AS "row", o_orderstatus AS "column", count(*) AS n FROM orders GROUP BY 1, 2),
t AS (SELECT r."row", c."column", coalesce(p.n, 0) AS n FROM (SELECT DISTINCT "row" FROM p) r CROSS JOIN (SELECT DISTINCT "column" FROM p) c LEFT JOIN p ON p."row" = r."row" AND p."column" = c."column")"""


def _cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.crosstab(_read(spark, sf_dir, "orders"), F.col("o_orderpriority"), F.col("o_orderstatus"))


@register("crosstab_priority_status", f"{_CROSS} SELECT * FROM t")
def crosstab_priority_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cross(spark, sf_dir)


@register(
    "heatmap_order",
    f"""{_CROSS}, rt AS (SELECT "row", sum(n) AS row_total, row_number() OVER (ORDER BY sum(n) DESC, "row") AS row_place FROM t GROUP BY 1),
ct AS (SELECT "column", sum(n) AS column_total, row_number() OVER (ORDER BY sum(n) DESC, "column") AS column_place FROM t GROUP BY 1)
SELECT t."row", t."column", n, CAST(row_total AS BIGINT) AS row_total, CAST(row_place AS INTEGER) AS row_place, CAST(column_total AS BIGINT) AS column_total, CAST(column_place AS INTEGER) AS column_place
FROM t JOIN rt USING ("row") JOIN ct USING ("column")""",
)
def heatmap_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.crosstab_totals(_cross(spark, sf_dir))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").withColumn("labels", standard.diseases(INDICATION.column()))


@register("multilabel_explode", f"WITH {_LABELLED} SELECT o_orderkey, unnest(labels) AS label FROM labelled")
def multilabel_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select("o_orderkey", F.explode("labels").alias("label"))


@register("label_counts", f"WITH {_LABELLED} SELECT label, count(*) AS n, count(*) FILTER (WHERE label = labels[1]) AS n_primary FROM (SELECT labels, unnest(labels) AS label FROM labelled) GROUP BY 1")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _labelled(spark, sf_dir).select("labels", F.explode("labels").alias("label"))
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("label") == F.element_at("labels", 1)).alias("n_primary"))


_PAIRS = f"WITH {_LABELLED}, p AS (SELECT label, o_orderpriority AS other, count(*) AS n FROM (SELECT *, unnest(labels) AS label FROM labelled) WHERE label <> 'Unclassified' GROUP BY 1, 2)"


@register("edge_threshold", f"{_PAIRS} SELECT * FROM p WHERE n >= 10")
def edge_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.edges(_labelled(spark, sf_dir), F.col("labels"), F.col("o_orderpriority"), 10)


@register("edge_top40_fallback", f"{_PAIRS} SELECT * FROM p ORDER BY n DESC, label, other LIMIT 40")
def edge_top40_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.edges(_labelled(spark, sf_dir), F.col("labels"), F.col("o_orderpriority"), 10**12)


@register(
    "weighted_degree",
    f"""{_PAIRS}, e AS (SELECT * FROM p WHERE n >= 10) SELECT node, side, CAST(sum(n) AS BIGINT) AS degree, round(180 + 8 * sqrt(sum(n)), 6) AS size
FROM (SELECT label AS node, 'label' AS side, n FROM e UNION ALL SELECT other, 'other', n FROM e) GROUP BY 1, 2""",
)
def weighted_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.weighted_degrees(edge_threshold(spark, sf_dir)), "size")


_FILLED = {"nct": "t LIKE '%(NCT%'", "sample": "regexp_matches(t, '[0-9]{2,5} (patients|participants|adults)')", "cohort": "t LIKE '%N = %'"}


@register(
    "fill_rates",
    " UNION ALL ".join(f"SELECT '{k}' AS field, count(*) FILTER (WHERE {v}) AS n, CAST(floor(100 * count(*) FILTER (WHERE {v}) / count(*)) AS BIGINT) AS percent FROM (SELECT {ABSTRACT.sql()} AS t FROM orders)" for k, v in _FILLED.items()),
)
def fill_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    tests = {"nct": t.contains("(NCT"), "sample": t.rlike("[0-9]{2,5} (patients|participants|adults)"), "cohort": t.contains("N = ")}
    return analytics.coverage(_read(spark, sf_dir, "orders").select(ABSTRACT.column().alias("t")), tests)


@register("top_years", "SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, year LIMIT 10")
def top_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("J Example. "), F.date_format("o_orderdate", "yyyy MMM"), F.lit(";1(2)"))
    return _read(spark, sf_dir, "orders").groupBy(extract.year(line).alias("year")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "year").limit(10)


_SHARES = case("seg", [(p, v) for p, v in tables.ETHNICITIES if "(?" not in p] + [(r"\bhispanic\b|\blatino\b", "Hispanic/Latino")], "''")
_ETHNIC = f"""seg AS (SELECT o_orderkey, {_SHARES} AS label, try_cast(nullif(regexp_extract(seg, '([0-9]+([.][0-9]+)?)[ ]*%', 1), '') AS DOUBLE) / 100 AS w
FROM (SELECT o_orderkey, lower(unnest(regexp_split_to_array({ETHNICITY.sql()}, '\\s*[+]\\s*|\\s*[|][|]\\s*|;'))) AS seg FROM orders)),
tot AS (SELECT o_orderkey, coalesce(sum(w), 0) AS ws, count(*) FILTER (WHERE w IS NULL) AS open, count(*) AS k FROM seg WHERE label <> '' GROUP BY 1),
sh AS (SELECT o_orderkey, label, coalesce(w, case when open = k then 1.0 else greatest(0, 1 - ws) end / open) AS s FROM seg JOIN tot USING (o_orderkey) WHERE label <> ''),
shares AS (SELECT o_orderkey, label, sum(s) / sum(sum(s)) OVER (PARTITION BY o_orderkey) AS share FROM sh GROUP BY 1, 2)"""


@register("ethnicity_shares", f"WITH {_ETHNIC} SELECT o_orderkey, label, round(share, 6) AS share FROM shares")
def ethnicity_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", F.explode(standard.ethnicity_shares(ETHNICITY.column())).alias("s"))
    return rows.select("o_orderkey", F.col("s.label").alias("label"), F.round("s.share", 6).alias("share"))


_BOOK = "SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, label) AS INTEGER) AS id, label, count(*) AS frequency, case when row_number() OVER (ORDER BY count(*) DESC, label) <= 6 then substr('ABCDEF', CAST(row_number() OVER (ORDER BY count(*) DESC, label) AS INTEGER), 1) else '' end AS code"


def _ethnic_labels():
    return F.transform(standard.ethnicity_shares(ETHNICITY.column()), lambda x: x["label"])


@register("ethnicity_codebook", f"WITH {_ETHNIC} {_BOOK} FROM shares GROUP BY label")
def ethnicity_codebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.codebook(_read(spark, sf_dir, "orders"), _ethnic_labels())


@register(
    "ethnicity_vector",
    f"""WITH {_ETHNIC}, book AS ({_BOOK} FROM shares GROUP BY label)
SELECT o_orderkey, """
    + ", ".join(f"round(coalesce(sum(share) FILTER (WHERE code = '{c}'), 0), 6) AS {c.lower()}" for c in "ABCDEF")
    + " FROM shares JOIN book USING (label) GROUP BY 1",
)
def ethnicity_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares in six slots, one for each of the codebook's first labels; the codebook's side has six rows."""
    orders = _read(spark, sf_dir, "orders")
    book = analytics.codebook(orders, _ethnic_labels()).where("code != ''").agg(F.array_sort(F.collect_list(F.struct("id", "label"))).alias("book"))
    rows = orders.select("o_orderkey", standard.ethnicity_shares(ETHNICITY.column()).alias("s")).where(F.size("s") > 0).crossJoin(F.broadcast(book))

    def slot(i: int):
        label = F.try_element_at(F.col("book"), F.lit(i + 1))["label"]
        return F.round(F.aggregate(F.filter("s", lambda x: x["label"] == label), F.lit(0.0), lambda a, x: a + x["share"]), 6)

    return rows.select("o_orderkey", *(slot(i).alias(c) for i, c in enumerate("abcdef")))


_JOBS = hits("lower(t)", tables.OCCUPATIONS)


@register(
    "occupation_codebook",
    f"WITH l AS (SELECT unnest(case when len(h) > 0 then list_distinct(h) else [t] end) AS label FROM (SELECT t, {_JOBS} AS h FROM (SELECT {OCCUPATION.sql()} AS t FROM orders))) {_BOOK} FROM l GROUP BY label",
)
def occupation_codebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.codebook(_read(spark, sf_dir, "orders"), standard.occupations(OCCUPATION.column()))


@register(
    "evidence_summary",
    f"""WITH {_LABELLED}, e AS (SELECT l.*, CAST(floor(o_totalprice / 100) AS BIGINT) AS size FROM labelled l JOIN orders USING (o_orderkey))
SELECT label, o_orderpriority AS kind, count(*) AS n, CAST(sum(size) AS BIGINT) AS total_size, max(size) AS most, round(avg(size), 6) AS mean_size
FROM (SELECT *, unnest(labels) AS label FROM e) GROUP BY 1, 2""",
)
def evidence_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence rows by disease and kind: texts labelled, exploded and summed in one shuffle."""
    size = F.floor(F.col("o_totalprice") / 100).cast("long")
    rows = _labelled(spark, sf_dir).select(F.explode("labels").alias("label"), F.col("o_orderpriority").alias("kind"), size.alias("size"))
    return rows.groupBy("label", "kind").agg(
        F.count("*").alias("n"), F.sum("size").alias("total_size"), F.max("size").alias("most"), F.round(F.avg("size"), 6).alias("mean_size")
    )
