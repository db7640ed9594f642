"""Queries of the text operators, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import age, arms, extract, rules, standard, tables, text
from corvane.operators import records
from corvane.plans.carrier import Carrier, Number, Pick, case, count, dedupe, first, found, hits, joined, quote
from corvane.plans.golden import worked
from corvane.registry import register

ABSTRACT = Carrier(
    Pick("o_orderkey", ["Major depressive disorder trial. ", "Bipolar depression study. ", "PTSD and sleep. ", "Dementia care. ", "Cancer pain trial. ", "A genetic biomarker of cortisol. ", "Notes. "]),
    Pick("o_custkey", ["N = ", "A total of ", "We randomized ", "Mean = ", "enrolled "]),
    Number("o_custkey % 900 + 3"),
    Pick("o_orderkey", [" patients", " participants", " adults", " cases"]),
    " received ",
    Pick("o_orderkey + o_custkey", ["sertraline", "Fluoxetine", "ketamine", "CBT", "placebo", "tofacitinib", "lorazepam", "usual food"]),
    " ",
    Number("o_orderkey % 90 + 5"),
    Pick("o_custkey", [" mg", " mg/day", " ml", " points", "mg/kg"]),
    " in a ",
    Number("o_orderkey % 24 + 1"),
    Pick("o_orderkey", ["-week trial", " months follow-up", " year study", " day run"]),
    Pick("o_orderkey", [" (NCT00012", " (registry ", " (NCT 1234"]),
    Number("o_custkey % 900 + 100"),
    "). ",
    Pick("o_custkey", ["Scores were significantly improved", "There was no significant difference", "Nausea and headache were common", "It was well tolerated", "A serious adverse event occurred", "Overall survival was"]),
    " ",
    Number("o_orderkey % 60"),
    Pick("o_orderkey", [" months", " %", " points"]),
    " (p < 0.0",
    Number("o_custkey % 9 + 1"),
    Pick("o_custkey", [", p=.0", "; P = 0.", ", OR = "]),
    Number("o_orderkey % 9 + 1"),
    "; 95% CI 0.",
    Number("o_orderkey % 9"),
    " to 2.",
    Number("o_custkey % 9"),
    "). ",
    Pick("o_orderkey + 1", ["Nausea, insomnia and NAUSEA were seen.", "Side effects were mild.", "Remission was frequent."]),
)

#: Tasks for each core where keys are dealt out before long work on their texts.
TASKS = 4

_T = "t"
_NAMED = dedupe(found(_T, tables.DRUGS))
_ENDINGS = f"list_filter({found(_T, tables.DRUG_ENDINGS)}, lambda x: len(x) > 6)"
_DOSES = f"list_transform(list_zip({found(_T, tables.DOSE)}, {found(_T, tables.DOSE, 1)}, {found(_T, tables.DOSE, 2)}), lambda z: struct_pack(w := z[1], k := z[2] || '|' || lower(z[3])))"
_SAMPLES = " || ".join(found(_T, p, 1) for p in tables.SAMPLES)
_P_VALUES = " || ".join(f"list_transform({found(_T, p)}, lambda z: trim(z))" for p in tables.P_VALUES)
_GOOD, _BAD, _HARM, _SAFE = (count(_T, p) for p in (tables.POSITIVE, tables.NEGATIVE, tables.HARMFUL, tables.HARMLESS))
_R = {k: quote(v) for k, v in tables.RESULTS.items()}
_FOLLOW = ", ".join(
    f"{first(_T, p, 1)} || ' ' || lower({first(_T, p, 2)}) || case when cast({first(_T, p, 1)} as int) > 1 then 's' else '' end" for p in tables.FOLLOW_UPS
)


@register(
    "extract_row",
    f"""
WITH a AS (SELECT o_orderkey, {ABSTRACT.sql()} AS t FROM orders),
b AS (SELECT *, {_P_VALUES} AS p, {_NAMED} || {_ENDINGS} AS d, {dedupe(_DOSES, '({}).k')} AS doses,
  list_sort(list_distinct(list_filter(list_transform({_SAMPLES}, lambda z: cast(z as int)), lambda z: z between 5 and 99999))) AS n,
  {dedupe(found(_T, tables.EVENTS))} AS ev, {_GOOD} AS good, {_BAD} AS bad, {_HARM} AS harm, {_SAFE} AS safe,
  {count(_T, tables.EFFICACY)} AS eff, {count(_T, tables.MECHANISM)} AS mech FROM a)
SELECT o_orderkey, 'NCT' || {first(_T, 'NCT[ ]*([0-9]{6,8})', 1, '')} AS nct,
  {joined(dedupe('d'), 5)} AS drugs, {case("' ' || substr(t, 1, 500)", tables.INDICATIONS, 'NULL')} AS indication,
  case when eff = 0 and mech = 0 then {quote(tables.OBJECTIVES['other'])} when mech > eff then {quote(tables.OBJECTIVES['mechanism'])} else {quote(tables.OBJECTIVES['efficacy'])} end AS objective,
  case when good = 0 and bad = 0 and harm = 0 and safe = 0 then {_R['unknown']} when good = 0 and bad = 0 and harm > 0 and safe = 0 then {_R['toxic']}
    when good = 0 and bad = 0 and safe > 0 and harm = 0 then {_R['safe']} when good > bad then {_R['effective']} else {_R['ineffective']} end AS outcome,
  case when len(doses) > 0 then array_to_string(list_transform(doses[1:4], lambda z: trim(z.w)), '; ') end AS dose,
  coalesce({_FOLLOW}) AS followup,
  substr(trim(coalesce({', '.join(first(_T, p) for p in tables.SURVIVAL)})), 1, 100) AS os,
  substr(trim(coalesce({', '.join(first(_T, p) for p in tables.PROGRESSION)})), 1, 100) AS pfs,
  {joined(dedupe('p', "regexp_replace(lower({}), '[ ]+', '', 'g')"), 6)} AS p_values,
  {joined(f"list_transform(list_zip({found(_T, tables.INTERVAL, 1)}, {found(_T, tables.INTERVAL, 2)}), lambda z: z[1] || ' to ' || z[2])", 4)} AS ci,
  {joined(f"list_transform({found(_T, tables.RATIO)}, lambda z: trim(z))", 4)} AS or_rr_hr,
  {joined('list_transform(n, lambda z: cast(z as varchar))', 5)} AS sample_size,
  coalesce({joined('ev', 8)}, substr(trim({first(_T, tables.EVENT_SENTENCE)}), 1, 150)) AS toxicity
FROM b""",
)
def extract_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    # A file's row groups may be fewer than the cores, and a text takes far longer than the shuffle of its keys.
    texts = orders.repartition(TASKS * spark.sparkContext.defaultParallelism).select("o_orderkey", ABSTRACT.column().alias("t")).withColumn("words", rules.beginnings(F.col("t")))
    fields = extract.all_fields(F.col("t"), words=F.col("words"))
    return texts.select("o_orderkey", *(c.alias(name) for name, c in fields.items()))


FIELDS = {
    "size": Carrier(Pick("o_orderkey", ["n = ", "", "about "]), Number("o_custkey % 90 + 1"), Pick("o_custkey", ["", "-40", ",200", " pairs"])),
    "follow_up": Carrier(Number("o_orderkey % 50 + 1"), Pick("o_custkey", [" weeks", "-90 days", " months; 2 years", " year", "-month", " days"])),
    "severity": Carrier(
        Pick("o_orderkey", ["mild to moderate", "moderate-severe", "severe", "mild to severe", "mild-to-severe", "PHQ-9 >= 10", "HAM-D score > 24", "MADRS >= 7", "BDI-II > 13", "first-episode"]),
        Pick("o_custkey", ["", " depression", " || moderate"]),
    ),
    "gender": Carrier(Number("o_orderkey % 101"), Pick("o_custkey", ["% male", "% Female", "% male + 30% female", " people"])),
    "social": Carrier(Pick("o_orderkey", ["Pregnant", "Veterans", "Smokers", "HIV-positive", "Low-income", "with diabetes"]), Pick("o_custkey", ["", " || Alcohol use history", "; homeless"])),
}
_DURATIONS = r"(\d+(?:\.\d+)?(?:\s*(?:to|-)\s*\d+(?:\.\d+)?)?)\s*(day|days|week|weeks|month|months|year|years)"
_CODES_BY_WORD = ", ".join(f"case when regexp_matches(lower(severity), '\\b{w}\\b') then {c} end" for w, c in tables.SEVERITY_WORDS)


def _listed(rules, default: str) -> str:
    return case("lower(severity)", [(p, _Raw(list(codes))) for p, codes in rules], default)


class _Raw:
    """A list as SQL."""

    def __init__(self, items: list[int]) -> None:
        self.items = items

    def __str__(self) -> str:
        return str(self.items)


_PHRASE_HITS = "flatten([" + ", ".join(f"case when regexp_matches(lower(severity), {quote('(?i)' + p)}) then {list(c)} else [] end" for p, c in tables.SEVERITY_PHRASES) + "])"
_MEN, _WOMEN = (first("lower(gender)", rf"(\d+(?:\.\d+)?)\s*%\s*{who}", 1) for who in ("male", "female"))
_SOCIAL = hits("lower(social)", tables.SOCIAL_CODES)


@register(
    "standardize_row",
    f"""
WITH a AS (SELECT o_orderkey, {', '.join(f'{c.sql()} AS {n}' for n, c in FIELDS.items())} FROM orders),
b AS (SELECT *, {_PHRASE_HITS} AS by_phrase, {_listed(tables.SEVERITY_SCALES, '[]')} AS by_scale,
  list_filter([{_CODES_BY_WORD}], lambda x: x is not null) AS by_word, {_SOCIAL} AS s FROM a)
SELECT o_orderkey, try_cast(regexp_replace(size, '[^0-9]', '', 'g') AS BIGINT) AS sample_size,
  round(list_max(list_transform(list_zip({found('lower(follow_up)', _DURATIONS, 1)}, {found('lower(follow_up)', _DURATIONS, 2)}), lambda z:
    cast(regexp_extract(z[1], '([0-9]+([.][0-9]+)?)$', 1) AS DOUBLE)
    * case when starts_with(z[2], 'day') then 1 / 30.0 when starts_with(z[2], 'week') then 0.25 when starts_with(z[2], 'month') then 1.0 else 12.0 end)), 6) AS months,
  array_to_string(list_reverse_sort(list_distinct(case when len(by_phrase) > 0 then by_phrase when len(by_scale) > 0 then by_scale else by_word end)), ',') AS severity,
  round(coalesce(cast({_MEN} AS DOUBLE) / 100, 1 - cast({_WOMEN} AS DOUBLE) / 100), 6) AS male,
  array_to_string(case when len(s) = 0 and not regexp_matches(lower(social), {quote(tables.OTHER_DISEASE)}) then [6]
    when not list_contains(s, 3) and regexp_matches(lower(social), {quote(tables.OTHER_DISEASE)}) then list_append(s, 5) else s end, ',') AS social
FROM b""",
)
def standardize_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    c = {n: x.column() for n, x in FIELDS.items()}

    def listed(codes):
        return F.array_join(F.transform(codes, lambda x: x.cast("string")), ",")

    return orders.select(
        "o_orderkey",
        standard.sample_digits(c["size"]).alias("sample_size"),
        F.round(standard.follow_up_months(c["follow_up"]), 6).alias("months"),
        listed(standard.severity_codes(c["severity"])).alias("severity"),
        F.round(standard.male_proportion(c["gender"]), 6).alias("male"),
        listed(standard.social_codes(c["social"])).alias("social"),
    )


ARM = Carrier(
    Pick("o_orderkey", ["Venlafaxine XR", "normal saline", "TAU", "waiting-list", "sham tDCS", "control", "Esketamine nasal spray", "CBT plus sertraline", "no treatment", "Bupropion SR tablets", "standard of care", "yoga"]),
    Pick("o_custkey", ["", " 75 mg/day", " capsules", " infusion"]),
)
TYPE = Pick("o_custkey + o_orderkey", ["", "drug", "Behavioral therapy", "device", "unclear", "Dietary supplement"])
_A = "lower(trim(a))"


@register(
    "arm_labels",
    f"""
WITH x AS (SELECT o_orderkey, {ARM.sql()} AS a, lower({TYPE.sql()}) AS k FROM orders)
SELECT o_orderkey, {case(_A, arms.CONTROLS, "''")} AS control, {case(_A, arms.RELEASES, "''")} AS release, {case(_A, arms.FORMS, "''")} AS form,
  case when regexp_matches({_A}, {quote(arms.COMBINED)}) and not regexp_matches({_A}, {quote(arms.NOT_COMBINED)}) then 'Combination Product'
    else coalesce({case('k', arms.TYPES, 'NULL')}, {case(_A, arms.TYPES_BY_NAME, "'Other'")}) end AS kind
FROM x""",
)
def arm_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = ARM.column()
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey",
        arms.control_term(a).alias("control"),
        arms.release_type(a).alias("release"),
        arms.dosage_form(a).alias("form"),
        arms.intervention_type(TYPE.column(), a).alias("kind"),
    )


worked(
    "age_vector",
    ("text",),
    ("kind", "mean", "sd", "low", "high"),
    lambda t: _age_cells(t),
    [
        ("18-65", "numeric_range", 0.0, 0.0, 18.0, 65.0),
        ("mean age 45.2 +/- 10.1 years", "mean_sd", 45.2, 10.1, 0.0, 0.0),
        ("mean 40, sd 7", "mean_sd", 40.0, 7.0, 0.0, 0.0),
        ("Median 40", "median", 40.0, 0.0, 0.0, 0.0),
        ("median 40, sd 6", "median", 40.0, 6.0, 0.0, 0.0),
        ("median 40 (18-65)", "median", 40.0, 0.0, 18.0, 65.0),
        ("average 33", "mean", 33.0, 0.0, 0.0, 0.0),
        ("65+", "lower_bound", 0.0, 0.0, 65.0, 0.0),
        (">= 60 years", "lower_bound", 0.0, 0.0, 60.0, 0.0),
        ("60 or older", "lower_bound", 0.0, 0.0, 60.0, 0.0),
        ("under 12", "upper_bound", 0.0, 0.0, 0.0, 12.0),
        ("6-18 months", "numeric_range", 0.0, 0.0, 0.5, 1.5),
        ("6 months", "single_value", 0.5, 0.0, 0.0, 0.0),
        ("Older adults", "age_term", 0.0, 0.0, 60.0, 79.0),
        ("Infants", "age_term", 0.0, 0.0, 0.1, 1.0),
        ("Students", "age_term", 0.0, 0.0, 0.0, 0.0),
        ("youth", "age_term", 0.0, 0.0, 0.0, 0.0),
        ("middle-aged", "age_term", 0.0, 0.0, 45.0, 64.0),
        ("people", "unknown", 0.0, 0.0, 0.0, 0.0),
        (None, "", 0.0, 0.0, 0.0, 0.0),
    ],
)


def _age_cells(stated):
    def cells(parsed):
        v = age.vector(parsed)
        return F.struct(parsed["kind"].alias("kind"), *(v[i].alias(n) for i, n in enumerate(("mean", "sd", "low", "high"))))

    return text.let(age.parse(stated), cells)


@register(
    "clean_documents",
    r"""
SELECT doc_id, c AS cleaned, case when length(c) <= 60 then c else regexp_replace(substr(c, 1, 57), '[ ,;:-]+$', '') || '...' END AS clipped,
  regexp_replace(lower(trim(text)), '[^a-z0-9]+', '', 'g') AS ascii_key, CAST(greatest(1, ceil(length(text) / 4)) AS BIGINT) AS tokens
FROM (SELECT *, trim(regexp_replace(text, '[ \t\n\r\f\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')) AS c FROM documents)""",
)
def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", text.clean(F.col("text")).alias("cleaned"))
    return docs.select("doc_id", "cleaned", text.clip(F.col("cleaned"), 60).alias("clipped"), text.ascii_key(F.col("text")).alias("ascii_key"), text.token_estimate(F.col("text")).alias("tokens"))


LABELS = Carrier(Pick("o_orderkey", ["Adults", "students ", "Nurses"]), Pick("o_custkey", [" || ", ";"]), Pick("o_orderkey + o_custkey", ["adults", "Teachers", "", "NURSES"]), " || ", Pick("o_orderkey", ["Teachers", "adults; veterans"]))


@register(
    "ordered_labels",
    f"""
WITH a AS (SELECT o_orderkey, list_filter(list_transform(regexp_split_to_array({LABELS.sql()}, '\\s*\\|\\|\\s*|;'), lambda x: trim(x)), lambda x: x <> '') AS l FROM orders)
SELECT o_orderkey, array_to_string({dedupe('l')}, ' || ') AS labels FROM a""",
)
def ordered_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", text.merge_labels(text.fragments(LABELS.column())).alias("labels"))


# A corpus of numbered records with labelled sections for each nation's suppliers.
RECORD = Carrier("BACKGROUND: Supply of ", Number("s_suppkey"), " items. METHODS: ", Number("s_suppkey % 70 + 10"), " patients. RESULTS: Score ", Number("s_nationkey"), ". METHODS: More. CONCLUSIONS: Done.")


@register(
    "split_records",
    f"""SELECT n AS nation, row_number() OVER (PARTITION BY n ORDER BY k) AS record_id, k || '. J Example. 2004.' || chr(10) || chr(10) || t AS record
FROM (SELECT s_nationkey AS n, s_suppkey AS k, {RECORD.sql()} AS t FROM supplier)""",
)
def split_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation's corpus is glued together, then split by its numbered first lines."""
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        "s_nationkey", "s_suppkey", F.concat(F.col("s_suppkey").cast("string"), F.lit(". J Example. 2004.\n\n"), RECORD.column()).alias("r")
    )
    corpora = rows.groupBy("s_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "r"))), lambda x: x["r"]), "\n\n").alias("corpus"))
    cut = corpora.select("s_nationkey", F.posexplode(records.split_numbered(F.col("corpus"))).alias("at", "record"))
    return cut.select(F.col("s_nationkey").alias("nation"), (F.col("at") + 1).cast("long").alias("record_id"), "record")


@register(
    "segment_sections",
    """
SELECT s_suppkey, unnest(['background', 'methods', 'results', 'conclusions']) AS section,
  unnest(['Supply of ' || s_suppkey || ' items.', (s_suppkey % 70 + 10) || ' patients. More.', 'Score ' || s_nationkey || '.', 'Done.']) AS content
FROM supplier""",
)
def segment_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.segment(spark.read.parquet(f"{sf_dir}/supplier.parquet"), "s_suppkey", RECORD.column())


@register("json_rows", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a model's answer: text around the JSON block is dropped, what doesn't parse gives no row."""
    raw = F.concat(F.lit("Here it is: "), F.col("props"), F.lit(" - done"))
    block = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.from_json(block, "k bigint").alias("j"))
    return events.select("event_id", F.col("j.k").alias("k")).where("k is not null")
