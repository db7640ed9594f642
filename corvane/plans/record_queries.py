"""Worked examples of parsed records, errors, assembled rows, rescue and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.phrases import column, structure
from corvane.operators import analytics, assembly, parsing, relational, rescue, resilience
from corvane.plans.carrier import quote
from corvane.plans.golden import worked
from corvane.registry import register

_BLOCK = """1. J Example Med. 2004 Mar;12(3):1-9. doi: 10.1234/jem.2004.001.

Sertraline versus placebo in adults with major depression: a randomized trial.

Doe J(1), Roe R(2), Poe P(1).

Author information:
(1)Example University.

BACKGROUND: Depression is common.
METHODS: 120 patients.

Conflict of interest statement: None.

DOI: 10.1234/other
PMID: 10000001"""

worked(
    "parse_export",
    ("block",),
    ("index", "pmid", "doi", "journal_line", "title", "abstract"),
    lambda b: column(parsing.export_block, parsing.EXPORT)(b),
    [
        (
            _BLOCK, 1, "10000001", "10.1234/jem.2004.001", "J Example Med. 2004 Mar;12(3):1-9",
            "Sertraline versus placebo in adults with major depression: a randomized trial.", "BACKGROUND: Depression is common. METHODS: 120 patients.",
        ),
        ("2. Ann Ex. 2010;1:2.", 2, "", "", "Ann Ex. 2010;1:2", "", ""),
        ("3. J Ex.\n\n2011 May 3.\n\nA title of a study.\n\nText one. The authors declare no competing interests.\n\nCopyright 2011 us.\n\nPMCID: PMC1\nPMID: 9", 3, "9", "", "J Ex", "A title of a study.", "Text one."),
        ("4. J Ex.\n10.1000/abc.\n\nTitle here.\n\nSee 10.2000/def for more.", 4, "", "10.1000/abc", "J Ex. 10.1000/abc", "Title here.", "See 10.2000/def for more."),
        ("no number", None, None, None, None, None, None),
        ("", None, None, None, None, None, None),
    ],
)

_RECORD = """[3]  J Med
PMID: 77  DOI: 10.1/x.  Year: 2011
A trial of walking for low mood in older adults

METHODS: 40 adults. RESULTS: Mood improved.
NCT00000001 was used."""
_PARTS = structure(("journal_line", "pmid", "nct_id", "doi", "year", "title", "methods", "results", "summary"))


def _flat(text: str) -> dict:
    found = parsing.record(text)
    own = found["sections"]
    return {n: found.get(n, own.get(n.upper(), "")) for n in _PARTS.fieldNames()}


worked(
    "parse_record",
    ("text",),
    tuple(_PARTS.fieldNames()),
    lambda t: column(_flat, _PARTS)(t),
    [
        (_RECORD, "J Med", "77", "NCT00000001", "10.1/x", "2011", "A trial of walking for low mood in older adults", "40 adults.", "Mood improved. NCT00000001 was used.", ""),
        ("J Old. 1999 Jan\n1999 Jan 3\nShort\nPlain text of an abstract without any label.", "J Old. 1999 Jan", "", "", "", "1999", "Short Plain text of an abstract without any label", "", "", ""),
        ("J New. 2020\nMETHODS: none\nCONCLUSIONS AND MORE: x", "J New. 2020", "", "", "", "2020", "", "none CONCLUSIONS AND MORE: x", "", ""),
        ("", "", "", "", "", "", "", "", "", ""),
        (None, "", "", "", "", "", "", "", "", ""),
    ],
)

_KINDS = tuple(resilience.KINDS)
_ERRORS = structure((*_KINDS, "wait", "delay", "line"))


def _error(text: str) -> dict:
    delay = resilience.retry_delay(text)
    return {
        **{k: "yes" if resilience.is_kind(text, k) else "" for k in _KINDS},
        "wait": str(resilience.wait_of_message(text)),
        "delay": "" if delay is None else str(delay),
        "line": resilience.quota_message(429, text),
    }


worked(
    "error_kinds",
    ("message",),
    (*_KINDS, "wait", "delay", "line"),
    lambda m: column(_error, _ERRORS)(m),
    [
        ("HTTP 429: retry in 1500ms", "", "yes", "yes", "", "", "", "2", "2", "HTTP 429: HTTP 429: retry in 1500ms"),
        ("request too large", "yes", "", "", "", "yes", "", "0", "", "HTTP 429: request too large"),
        ("tokens per minute: Limit 10, Requested 20", "yes", "", "yes", "", "", "", "0", "", "HTTP 429: tokens per minute: Limit 10, Requested 20"),
        ("model returned invalid JSON", "", "", "", "yes", "yes", "", "0", "", "HTTP 429: model returned invalid JSON"),
        ("connection timed out", "", "yes", "", "", "", "", "0", "", "HTTP 429: connection timed out"),
        ("daily request quota", "", "", "", "", "", "yes", "0", "", "HTTP 429: daily request quota"),
        ('{"error": {"message": "Limit 5 Requested 9", "details": [{"retryDelay": "7s"}]}}', "", "yes", "", "", "", "", "0", "7", "HTTP 429: Limit 5 Requested 9 (limit=5, requested=9) Suggested wait: 7s."),
        ('{"error": "try again in 3s"}', "", "", "", "", "", "", "3", "3", "HTTP 429: try again in 3s Suggested wait: 3s."),
        ("", "", "", "", "", "", "", "0", "", "HTTP 429: "),
    ],
)


# Standardised rows: (size, follow-up, severity, age, gender, ethnicity, occupation, status) and what they become.
_CELLS = ("Sample Size", "Follow-up Time", "Severity", "Age", "Gender", "Ethnicity", "Occupation", "Social Status")
_STANDARD = [
    (("1,234", "8-12 weeks; 6 months", "mild to moderate", "18-65", "60% Female", "50% White + Black", "Nurses", "pregnant"), ("1234", "6.00", "[2,1]", "[0,0,18,65,0]", "", "0.40", "[0.50,0.50,0.00,0.00,0.00,0.00]", "Nurse", "1")),
    (("30-40", "90 days", "first-episode", "45.2+/-10.1", "Male", "White", "Farmers", "veterans"), ("3040", "3.00", "first-episode", "[45.2,10.1,0,0,0]", "", "1.00", "[1.00,0.00,0.00,0.00,0.00,0.00]", "Farmers", "6")),
    (("", "12-month", "severe", "Infants", "", "Asian + White", "", "alcohol use, homeless"), ("", "", "3", "[0,0,0.1,1,0]", "error", "", "[0.50,0.00,0.50,0.00,0.00,0.00]", "", "[2,4]")),
    (("n=12", "1 year", "PHQ-9 >= 10", "6 months", "Male + Female", "80% White, Black", "untreated", ""), ("12", "12.00", "[3,2]", "[0.5,0,0,0,0]", "error", "", "[0.00,1.00,0.00,0.00,0.00,0.00]", "", "")),
    (("7", "", "", "65+", "female", "White", "teachers and nurses", "HIV-positive"), ("7", "", "", "[0,0,65,0,0]", "", "0.00", "[1.00,0.00,0.00,0.00,0.00,0.00]", "Nurse || Teacher", "3")),
    (("", "", "", "", "", "", "", "with diabetes"), ("", "", "", "[0,0,0,0,0]", "", "", "[0.00,0.00,0.00,0.00,0.00,0.00]", "", "5")),
]
_SHOWN = ("size", "months", "severity", "age", "age_error", "male", "ethnicity", "occupation", "status")
_FROM = ("Sample Size", "Follow-up Time (Months)", "Severity", assembly.AGE, "Age Error", "Gender Male Proportion", assembly.VECTOR, "Occupation", "Social Status")
_VALUES = ", ".join(f"({i}, {', '.join(map(quote, out))})" for i, (_, out) in enumerate(_STANDARD))


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pairs, one an order, and demographic rows, several of some records, of which the last one counts."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    case = F.expr(f"cast(o_orderkey % {len(_STANDARD)} as int)")
    cells = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(_CELLS, given))) for given, _ in _STANDARD))
    rows = orders.select(F.concat(F.lit(" R"), F.col("o_orderkey").cast("string")).alias("Record ID"), F.col("o_orderkey").alias("seq"), F.get(cells, case).alias("x"))
    pairs = rows.select("Record ID", *(F.col("x").getField(n).alias(n) for n in _CELLS[:3]), F.lit("p").alias("PMID"), "seq")
    last = rows.select("Record ID", *(F.col("x").getField(n).alias(n) for n in _CELLS[3:]), F.col("seq"))
    early = last.withColumns({n: F.lit("early") for n in _CELLS[3:]}).withColumn("seq", F.col("seq") - 1)
    return pairs, early.unionByName(last)


@register(
    "standard_table",
    f"SELECT 'R' || o_orderkey AS record, {', '.join(_SHOWN)}, 'p' AS pmid FROM orders JOIN (VALUES {_VALUES}) AS e(i, {', '.join(_SHOWN)}) ON o_orderkey % {len(_STANDARD)} = i",
)
def standard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs and demographic rows upgraded, joined and standardised."""
    pairs, traits = _tables(spark, sf_dir)
    upgraded = assembly.upgrade_pairs(pairs)
    # The rows' own labels are shown, so they aren't upgraded here.
    raw = assembly.raw_rows(upgraded, traits.select(*(assembly.cell(traits, n).alias(n) for n in assembly.TRAITS), "seq"))
    done = assembly.standard_rows(raw)
    return done.select(F.col("Record ID").alias("record"), *(F.col(f"`{a}`").alias(b) for a, b in zip(_FROM, _SHOWN)), F.col("PMID").alias("pmid"))


@register(
    "standard_summary",
    "SELECT count(*) AS raw_row_count, count(*) AS normalized_row_count, count(*) FILTER (WHERE o_orderkey % 6 IN (2, 3)) AS age_error_count, 3 AS ethnicity_codebook_size, 3 AS occupation_codebook_size FROM orders",
)
def standard_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, traits = _tables(spark, sf_dir)
    raw = assembly.raw_rows(assembly.upgrade_pairs(pairs), traits.select(*(assembly.cell(traits, n).alias(n) for n in assembly.TRAITS), "seq"))
    return assembly.summary(raw, assembly.standard_rows(raw))


@register(
    "upgraded_traits",
    """SELECT 'R' || o_orderkey AS record, 'p' AS pmid,
  list_extract(['Nurse', 'Farmers', '', '', 'Nurse || Teacher', ''], CAST(o_orderkey % 6 AS INT) + 1) AS occupation,
  list_extract(['Pregnant', 'Veterans', 'Alcohol use history || Homeless', '', 'HIV-positive', ''], CAST(o_orderkey % 6 AS INT) + 1) AS status FROM orders""".replace(
        "'Alcohol use history || Homeless'", "'Homeless || Alcohol use history'"
    ),
)
def upgraded_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographic rows in one spelling, the record number of their pair filled in."""
    pairs, traits = _tables(spark, sf_dir)
    done = assembly.upgrade_traits(assembly.last_rows(traits.withColumn("Record ID", F.trim("Record ID"))), assembly.upgrade_pairs(pairs))
    return done.select(F.col("Record ID").alias("record"), F.col("PMID").alias("pmid"), F.col("Occupation").alias("occupation"), F.col("Social Status").alias("status"))


_RESCUE = """r AS (SELECT o_custkey AS record_id, o_orderkey AS seq, case when o_orderkey % 7 = 0 then 'women' else '' end AS p, case when o_orderkey % 5 = 0 then 'mild' else '' end AS s FROM orders),
g AS (SELECT record_id, bool_or(p <> '') AS some_p, bool_or(s <> '') AS some_s, bool_or(p = '') AS open_p, bool_or(s = '') AS open_s FROM r GROUP BY 1),
c AS (SELECT *, record_id % 2 = 0 AS pc, record_id % 3 = 0 AS sc, record_id % 2 = 0 AS lp, record_id % 6 = 0 AS ls FROM g)"""
_STEP = "case when {0} <> '' then 'own' when some_{0} then 'broadcast' when l{0} then 'local' else '' end"


def _rescue_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = orders.select(
        F.col("o_custkey").alias("record_id"),
        F.col("o_orderkey").alias("seq"),
        F.expr("case when o_orderkey % 7 = 0 then 'women' else '' end").alias("population_raw"),
        F.expr("case when o_orderkey % 5 = 0 then 'mild' else '' end").alias("severity"),
        F.lit("").alias("population_status"),
    )
    key = F.col("record_id")
    found = rows.select("record_id").distinct().select(
        "record_id",
        (key % 2 == 0).alias("population_cue"),
        (key % 3 == 0).alias("severity_cue"),
        F.when(key % 2 == 0, "adults").otherwise("").alias("local_population_raw"),
        F.when(key % 6 == 0, "severe").otherwise("").alias("local_severity"),
    )
    return rows, found


@register(
    "rescue_status",
    f"""WITH {_RESCUE}, e AS (SELECT r.*, pc, sc, {_STEP.format('p')} AS fp, {_STEP.format('s')} AS fs FROM r JOIN c USING (record_id))
SELECT record_id, seq, case fp when 'own' then p when 'broadcast' then 'women' when 'local' then 'adults' else '' end AS population_raw,
  case fs when 'own' then s when 'broadcast' then 'mild' when 'local' then 'severe' else '' end AS severity,
  case when fp = 'own' then case when fs = 'local' then 'main_pass_plus_local_severity' else 'main_pass' end
    when fp <> '' then case when 'local' IN (fp, fs) then case when fs IN ('broadcast', 'local') then 'local_rescue_population_and_severity' else 'local_rescue_population' end else 'record_broadcast' end
    when fs = 'own' then 'main_pass_severity_only' when fs = 'local' then 'local_rescue_severity_only' when fs <> '' then 'record_broadcast'
    when pc OR sc then 'cue_present_unresolved' else 'no_population_cue' end AS population_status FROM e""",
)
def rescue_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = _rescue_rows(spark, sf_dir)
    return rescue.enrich(rows, found).select("record_id", "seq", "population_raw", "severity", "population_status")


@register(
    "rescue_plan",
    f"""WITH {_RESCUE}, n AS (SELECT *, open_p AND (some_p OR lp OR pc) AS np, open_s AND (some_s OR ls OR sc) AS ns FROM c)
SELECT count(*) AS records, count(*) FILTER (WHERE np OR ns) AS candidates, count(*) FILTER (WHERE np) AS population_candidates,
  count(*) FILTER (WHERE ns) AS severity_candidates, count(*) FILTER (WHERE NOT pc AND NOT sc AND (open_p OR open_s)) AS no_cue_records FROM n""",
)
def rescue_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rescue.plan_counts(rescue.plan(*_rescue_rows(spark, sf_dir)))


@register(
    "rescue_answers",
    "SELECT o_custkey AS record_id, arg_max(v, struct_pack(n := len(v), k := -o_orderkey)) AS population_raw FROM (SELECT *, repeat('x', CAST(o_orderkey % 5 AS INT)) AS v FROM orders) GROUP BY 1",
)
def rescue_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a record's answers the longest one, the first of equals."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    answers = orders.select(F.col("o_custkey").alias("record_id"), F.col("o_orderkey").alias("seq"), F.expr("repeat('x', cast(o_orderkey % 5 as int))").alias("population_raw"), F.lit("").alias("severity"))
    return rescue.merged_answers(answers).select("record_id", F.col("model_population_raw").alias("population_raw"))


@register(
    "evidence_metrics",
    """SELECT count(*) AS row_count, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS source_files, count(*) AS non_empty_indication, count(*) FILTER (WHERE o_custkey % 3 <> 0) AS non_empty_intervention,
  0 AS non_empty_comparator, count(*) FILTER (WHERE o_orderkey % 4 <> 3) AS non_empty_severity, median(o_custkey) AS sample_size_median, CAST(max(o_custkey) AS DOUBLE) AS sample_size_max,
  median(o_orderkey / 4) AS follow_up_median_months, quantile_cont(o_orderkey / 4, 0.75) AS follow_up_q3_months, max(o_orderkey / 4) AS follow_up_max_months,
  count(*) FILTER (WHERE o_orderkey % 4 IN (0, 1)) AS severity_mapped_rows, count(*) FILTER (WHERE o_orderkey % 4 = 2) AS severity_retained_text_rows,
  count(*) FILTER (WHERE o_orderkey % 2 = 0) AS age, 0 AS gender, 0 AS ethnicity, count(*) AS occupation, 0 AS social_status, 0 AS treatment_history FROM orders""",
)
def evidence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    table = orders.select(
        F.lit(" MDD ").alias("Indication"),
        F.expr("case when o_custkey % 3 <> 0 then 'x' else ' ' end").alias("Intervention"),
        F.expr("element_at(array('2', '[3,2]', 'mild', ''), cast(o_orderkey % 4 as int) + 1)").alias("Severity"),
        F.format_number(F.col("o_custkey"), 0).alias("Sample Size"),
        (F.col("o_orderkey") / 4).cast("string").alias("Follow-up Months"),
        F.expr("case when o_orderkey % 2 = 0 then '[0,0,18,65,0]' else '[0,0,0,0,0]' end").alias("Age [x]"),
        F.lit("Nurse").alias("Occupation"),
        F.col("o_orderstatus").alias("Source File"),
    )
    return analytics.metrics(analytics.prepared(table)).withColumn("source_files", F.array_join("source_files", ","))


@register("first_numbers", "SELECT o_orderkey, CAST(case o_orderkey % 5 when 0 then 12345 when 1 then NULL when 2 then NULL when 3 then 2.5 else 8 end AS DOUBLE) AS size FROM orders")
def first_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = F.expr("element_at(array('12,345 (n=3)', 'abc', '-4', 'about 2.5 of 9', '8'), cast(o_orderkey % 5 as int) + 1)")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", analytics.first_number(texts).alias("size"))


@register(
    "stacked_outcomes",
    """WITH p AS (SELECT o_orderpriority AS row, o_orderstatus AS col, count(*) AS n FROM orders GROUP BY 1, 2), f AS (SELECT r.row, c.col AS "column", coalesce(p.n, 0) AS n
  FROM (SELECT DISTINCT row FROM p) r CROSS JOIN (SELECT DISTINCT col FROM p) c LEFT JOIN p ON p.row = r.row AND p.col = c.col)
SELECT row, "column", n, CAST(sum(n) OVER (PARTITION BY row) AS BIGINT) AS row_total,
  CAST((SELECT count(*) FROM (SELECT row, sum(n) AS t FROM f GROUP BY 1) x WHERE x.t > w.t OR (x.t = w.t AND x.row <= f.row)) AS INT) AS row_place,
  case "column" when 'P' then 1 when 'F' then 2 else 3 end AS part_place FROM f JOIN (SELECT row AS r2, sum(n) AS t FROM f GROUP BY 1) w ON w.r2 = f.row""",
)
def stacked_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return analytics.stacked(analytics.crosstab(orders, F.col("o_orderpriority"), F.col("o_orderstatus")), ["P", "F"])


@register("sorted_serials", "SELECT o_orderkey, 'S2-orders-' || row_number() OVER (ORDER BY o_custkey, o_orderkey) AS serial_id FROM orders")
def sorted_serials(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return relational.sorted_serials(orders.select("o_orderkey", "o_custkey"), "S2", "orders", F.col("o_custkey"), F.col("o_orderkey")).select("o_orderkey", "serial_id")


@register(
    "batch_members",
    "SELECT b AS batch, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS ids FROM (SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 64 AS BIGINT) AS b FROM customer) GROUP BY 1",
)
def batch_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    return relational.batch_members(customer, "c_custkey", F.col("c_custkey"), 64).select("batch", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


worked(
    "record_ids",
    ("id", "path"),
    ("label", "serial", "order_key", "source"),
    lambda i, p: {
        "label": relational.parsed_id(i, "S2")["label"],
        "serial": relational.parsed_id(i, "S2")["serial"],
        "order_key": relational.record_order(i),
        "source": relational.source_label(p),
    },
    [
        ("S2-my-corpus-12", "/a/b/my corpus (1).txt", "my-corpus", 12, 1000000000000, "my_corpus_1"),
        ("17", "x.y.csv", None, None, 17, "x.y"),
        ("FB-a-1", "/a/---.txt", None, None, 1000000000000, "source"),
        ("", "", None, None, 1000000000000, "source"),
        (None, None, None, None, 1000000000000, "source"),
    ],
)


@register(
    "fallback_rows",
    "SELECT c_custkey, coalesce(s, 'none') AS status, coalesce(p, 0) AS price FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS s, arg_max(o_totalprice, o_orderkey) AS p FROM orders GROUP BY 1) ON c_custkey = o_custkey",
)
def fallback_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is omitted has a fallback row."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    last = relational.last_write(orders, "c_custkey", "o_orderkey")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    return relational.with_fallback(customer, last, "c_custkey", {"status": F.lit("none"), "price": F.lit(0.0)})


@register(
    "matched_rows",
    "SELECT c_custkey, c_name, n FROM customer JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey",
)
def matched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return relational.matched(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name"), counts, "c_custkey", "c_custkey")


@register(
    "backfilled_rows",
    "SELECT o_orderkey, case when o_orderkey % 3 = 0 then o_orderstatus else coalesce(c_mktsegment, '') end AS label FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def backfilled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("key"), F.expr("case when o_orderkey % 3 = 0 then o_orderstatus else ' ' end").alias("label"))
    segments = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("label"))
    return relational.backfilled(orders, segments, "key", ["label"]).select("o_orderkey", "label")


@register(
    "completed_by_usage",
    "SELECT DISTINCT id AS record_id FROM (SELECT user_id AS id FROM events WHERE event_type IN ('click', 'purchase') UNION ALL SELECT unnest([user_id + 100000, user_id + 200000]) FROM events WHERE event_type = 'view')",
)
def completed_by_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that are complete by their rows, by notes, and by the ids of their calls."""
    kind = F.expr("case event_type when 'click' then 'row' when 'view' then 'usage' when 'purchase' then 'no_row' else 'meta' end")
    ids = F.array(F.col("user_id") + 100000, F.col("user_id") + 200000)
    log = spark.read.parquet(f"{sf_dir}/events.parquet").select(kind.alias("type"), F.col("user_id").alias("record_id"), ids.alias("completed_record_ids"))
    return relational.completed(log, by_usage=True)


@register("usage_totals", "SELECT CAST(sum(event_id) AS BIGINT) AS prompt_tokens, 0 AS completion_tokens, CAST(sum(user_id) AS BIGINT) AS total_tokens FROM events WHERE event_type = 'view'")
def usage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.create_map(F.lit("prompt_tokens"), F.col("event_id").cast("string"), F.lit("total_tokens"), F.col("user_id").cast("string"), F.lit("completion_tokens"), F.lit("none"))
    log = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.expr("case event_type when 'view' then 'usage' else 'row' end").alias("type"), data.alias("data"))
    return relational.usage_totals(log)
