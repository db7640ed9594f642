"""The evidence table: extracted arm pairs joined with their record's demographic fields, and standardised.

Column names are those of the tables that the stages exchange. A table lacks no
column: what an input does not have is empty. Rows of a record whose id is blank
find no demographic fields. Of several demographic rows of a record the last one
by ``seq`` counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import age, standard
from corvane.functions.text import bracketed, clean, ordered_dedupe
from corvane.operators.analytics import codebook

PAIR = [
    "Record ID", "Record Index", "PMID", "NCT ID", "Journal", "Year", "Indication", "Population Raw", "Severity", "Population Status", "Target", "Intervention",
    "Intervention Type", "Comparator", "Outcome Direction", "Phase", "Sample Size", "Follow-up Time", "Evidence Snippet",
]
TRAITS = ["Record ID", "PMID", "Age", "Gender", "Ethnicity", "Occupation", "Social Status", "Treatment History"]
RAW = [
    "Record ID", "Record Index", "PMID", "NCT ID", "Journal", "Year", "Indication", "Severity", "Intervention", "Intervention Type", "Comparator", "Outcome Direction",
    "Phase", "Sample Size", "Follow-up Time", "Age", "Gender", "Ethnicity", "Occupation", "Social Status", "Treatment History",
]
AGE = "Age [Mean_Age,SD_Age,Min_Age,Max_Age,N]"
#: The column of ethnicity shares; a report names its slots with ``vector_header``.
VECTOR = "Ethnicity"
STANDARD = [
    "Record ID", "Record Index", "PMID", "NCT ID", "Journal", "Year", "Indication", "Intervention", "Intervention Type", "Comparator", "Outcome Direction", "Phase",
    "Sample Size", "Follow-up Time (Months)", "Severity", AGE, "Age Error", "Gender Male Proportion", VECTOR, "Occupation", "Social Status", "Treatment History",
]
SLOTS = "ABCDEF"


def cell(df: DataFrame, name: str) -> Column:
    """A cleaned cell; empty where there is no such column."""
    return clean(F.col(f"`{name}`").cast("string")) if name in df.columns else F.lit("")


def first_of(*cells: Column) -> Column:
    """The first that isn't empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cells), F.lit(""))


def insert_after(headers: list[str], target: str, new: str) -> list[str]:
    """``headers`` with a new one after ``target``, or at the end; unchanged if it is there."""
    if new in headers:
        return list(headers)
    at = headers.index(target) + 1 if target in headers else len(headers)
    return [*headers[:at], new, *headers[at:]]


def upgrade_pairs(pairs: DataFrame) -> DataFrame:
    """The pairs' columns, with a treatment history after the severity that is found in the text where none is given."""
    history = first_of(cell(pairs, "Treatment History"), standard.treatment_text(cell(pairs, "Treatment History"), cell(pairs, "Population Raw")))
    names = insert_after(PAIR, "Severity", "Treatment History")
    return pairs.select(*((history if n == "Treatment History" else cell(pairs, n)).alias(n) for n in names), *(["seq"] if "seq" in pairs.columns else []))


def last_rows(df: DataFrame, key: str = "Record ID", seq: str = "seq") -> DataFrame:
    """The last row of each id; blank ids have none. One partial maximum by id, no window."""
    rest = [c for c in df.columns if c != key]
    packed = df.where(F.col(f"`{key}`") != "").groupBy(F.col(f"`{key}`")).agg(F.max_by(F.struct(*(F.col(f"`{c}`") for c in rest)), F.col(seq)).alias("_last"))
    return packed.select(F.col(f"`{key}`"), *(F.col("_last").getField(c).alias(c) for c in rest))


def upgrade_traits(traits: DataFrame, pairs: DataFrame) -> DataFrame:
    """Demographic rows with their labels in one spelling, helped by what the record's last pair says."""
    helper = last_rows(pairs.select("Record ID", "PMID", "Population Raw", "Treatment History", "seq")).toDF("_id", "_pmid", "_population", "_history", "_seq")
    own = traits.select(*(cell(traits, n).alias(n) for n in TRAITS), *(["seq"] if "seq" in traits.columns else []))
    joined = own.join(helper, F.col("`Record ID`") == F.col("_id"), "left")
    status, history = F.col("`Social Status`"), F.col("`Treatment History`")
    population, other = (F.coalesce(F.col(x), F.lit("")) for x in ("_population", "_history"))
    both = F.array_join(ordered_dedupe(F.array(population, status)), " || ")
    new = {
        "PMID": first_of(F.col("PMID"), F.coalesce(F.col("_pmid"), F.lit(""))),
        "Occupation": standard.occupation_text(F.col("Occupation")),
        "Social Status": standard.social_text(status, both),
        "Treatment History": standard.treatment_text(history, status, other, population),
    }
    return joined.select(*(new.get(n, F.col(f"`{n}`")).alias(n) for n in TRAITS), *(["seq"] if "seq" in own.columns else []))


def raw_rows(pairs: DataFrame, traits: DataFrame) -> DataFrame:
    """Every pair with the demographic fields of its record; the pair's treatment history counts where the record has none."""
    right = last_rows(traits).drop("seq")
    right = right.select(*(F.col(f"`{c}`").alias(f"_{c}") for c in right.columns))
    joined = pairs.join(right, F.col("`Record ID`") == F.col("`_Record ID`"), "left")

    def value(n: str) -> Column:
        if n in ("Age", "Gender", "Ethnicity", "Occupation", "Social Status"):
            return F.coalesce(F.col(f"`_{n}`"), F.lit(""))
        if n == "Treatment History":
            return first_of(F.coalesce(F.col(f"`_{n}`"), F.lit("")), F.col(f"`{n}`"))
        return F.col(f"`{n}`")

    return joined.select(*(value(n).alias(n) for n in RAW), *(["seq"] if "seq" in pairs.columns else []))


def ethnicity_codebook(rows: DataFrame) -> DataFrame:
    """(numeric_id, normalized_label, frequency, top6_code): labels by how many rows name them; there are as many as the rules have labels."""
    return codebook(rows, F.transform(standard.ethnicity_shares(F.col("Ethnicity")), lambda x: x["label"])).select(
        F.col("id").alias("numeric_id"),
        F.col("label").alias("normalized_label"),
        F.col("frequency"),
        F.col("code").alias("top6_code"),
    )


def top_labels(book: DataFrame) -> list[str]:
    """The labels of the six slots, in order."""
    rows = book.where(F.col("numeric_id") <= len(SLOTS)).select("numeric_id", "normalized_label").collect()  # six rows at most
    return [r[1] for r in sorted(rows)]


def vector_header(top: list[str]) -> str:
    slots = [f"{code}={top[i] if i < len(top) else 'Unassigned'}" for i, code in enumerate(SLOTS)]
    return "Ethnicity [" + ",".join(slots) + "]"


def ethnicity_vector(c: Column, top: list[str]) -> Column:
    """Shares of the six slots with two decimals, as ``[0.50,0.50,0.00,0.00,0.00,0.00]``; other labels count for none."""
    from corvane.functions.text import let

    def of(shares: Column) -> Column:
        def slot(label: str) -> Column:
            return standard.fixed(F.aggregate(F.filter(shares, lambda x: x["label"] == label), F.lit(0.0), lambda a, x: a + x["share"]))

        slots = [*map(slot, top), *[F.lit("0.00")] * (len(SLOTS) - len(top))]
        return F.concat(F.lit("["), F.concat_ws(",", *slots), F.lit("]"))

    return let(standard.ethnicity_shares(c), of)


def standard_rows(rows: DataFrame) -> DataFrame:
    """The 22 standardised columns of raw rows."""
    top = top_labels(ethnicity_codebook(rows))
    parsed = rows.withColumn("_age", age.parse(F.col("Age")))
    cells = age.vector(F.col("_age"))
    new = {
        "Sample Size": F.coalesce(standard.sample_digits(F.col("`Sample Size`")).cast("string"), F.lit("")),
        "Follow-up Time (Months)": standard.fixed(standard.follow_up_months(F.col("`Follow-up Time`"))),
        "Severity": standard.severity_cell(F.col("Severity")),
        AGE: F.concat(F.lit("["), F.concat_ws(",", *(standard.short_number(cells[i]) for i in range(5))), F.lit("]")),
        "Age Error": F.when(age.below_one(F.col("Age"), F.col("_age")), "error").otherwise(""),
        "Gender Male Proportion": standard.fixed(standard.male_proportion(F.col("Gender"))),
        VECTOR: ethnicity_vector(F.col("Ethnicity"), top),
        "Occupation": standard.occupation_text(F.col("Occupation")),
        "Social Status": bracketed(standard.social_codes(F.col("`Social Status`"))),
    }
    return parsed.select(*(new.get(n, F.col(f"`{n}`")).alias(n) for n in STANDARD), *(["seq"] if "seq" in rows.columns else []))


def summary(raw: DataFrame, standardised: DataFrame) -> DataFrame:
    """One row: raw_row_count, normalized_row_count, age_error_count, ethnicity_codebook_size, occupation_codebook_size."""
    sizes = raw.agg(F.count("*").alias("raw_row_count"))
    errors = standardised.agg(F.count("*").alias("normalized_row_count"), F.count_if(F.col("`Age Error`") == "error").alias("age_error_count"))
    people = raw.select(F.explode(F.transform(standard.ethnicity_shares(F.col("Ethnicity")), lambda x: x["label"])).alias("x"))
    work = raw.select(F.explode(standard.occupations(F.col("Occupation"))).alias("x"))
    counts = (d.agg(F.count_distinct("x").alias(n)) for d, n in ((people, "ethnicity_codebook_size"), (work, "occupation_codebook_size")))
    out = sizes
    for one in (errors, *counts):  # one row each
        out = out.crossJoin(one)
    return out
