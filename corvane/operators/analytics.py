"""Frequency tables, crosstabs, distributions, coverage and graph edges over evidence tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.standard import diseases, vector_nonzero
from corvane.functions.text import clean, number
from corvane.operators.relational import find_column, numbered

MISSING = "(Missing)"


def frequency(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """(name, frequency, share); blank values are ``(Missing)``."""
    shown = F.coalesce(F.nullif(F.trim(value.cast("string")), F.lit("")), F.lit(MISSING))
    counted = df.groupBy(shown.alias(name)).agg(F.count("*").alias("frequency"))
    total = df.agg(F.count("*").alias("total"))  # one row
    return counted.crossJoin(F.broadcast(total)).select(name, "frequency", (F.col("frequency") / F.col("total")).alias("share"))


def thresholds(df: DataFrame, size: Column, limits: list[int]) -> DataFrame:
    """(threshold, n, share): cumulative counts up to each limit."""
    one = df.select(size.alias("x")).where("x is not null and x >= 0").agg(F.count("*").alias("total"), *(F.count_if(F.col("x") <= t).alias(f"t{t}") for t in limits))
    pairs = F.array(*(F.struct(F.lit(f"<= {t}").alias("threshold"), F.col(f"t{t}").alias("n")) for t in limits))
    return one.select(F.explode(pairs).alias("p"), "total").select("p.threshold", "p.n", (F.col("p.n") / F.col("total")).alias("share"))


def size_bands(df: DataFrame, size: Column, limits: list[int]) -> DataFrame:
    """(band, n): disjoint bands between the limits, empty ones too."""
    edges = [-1, *limits]
    names = [f"{a + 1}-{b}" for a, b in zip(edges, limits)] + [f"> {limits[-1]}"]
    tests = [(F.col("x") > a) & (F.col("x") <= b) for a, b in zip(edges, limits)] + [F.col("x") > limits[-1]]
    one = df.select(size.alias("x")).where("x is not null and x >= 0").agg(*(F.count_if(t).alias(f"b{i}") for i, t in enumerate(tests)))
    pairs = F.array(*(F.struct(F.lit(n).alias("band"), F.col(f"b{i}").alias("n")) for i, n in enumerate(names)))
    return one.select(F.explode(pairs).alias("p")).select("p.*")


def summary(df: DataFrame, size: Column) -> DataFrame:
    """n, mean, median, sd (0 for one row), min, max of a number."""
    x = size.cast("double")
    return df.agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.median(x).alias("median"),
        F.when(F.count(x) == 1, 0.0).otherwise(F.stddev_samp(x)).alias("sd"),
        F.min(x).alias("least"),
        F.max(x).alias("most"),
    )


def fixed_histogram(df: DataFrame, size: Column, low: float, high: float, bins: int) -> DataFrame:
    """(bin, start, n) of equal bins; the last one holds its upper edge, and empty bins stay."""
    x = size.cast("double")
    width = (high - low) / bins
    at = F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.where((x >= low) & (x <= high)).groupBy(at.alias("b")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), F.col("bin") == F.col("b"), "left").select(
        "bin", (F.lit(low) + F.col("bin") * width).alias("start"), F.coalesce("n", F.lit(0)).alias("n")
    )


def _bin(x: Column, bins: int) -> Column:
    """The place of ``x`` between ``a`` and ``b``, the last bin with its upper edge; the first where all values are equal."""
    width = F.nullif(F.col("b") - F.col("a"), F.lit(0.0))
    return F.coalesce(F.least(F.floor((x - F.col("a")) / width * bins), F.lit(bins - 1)), F.lit(0)).cast("int")


def log_histogram(df: DataFrame, size: Column, bins: int) -> DataFrame:
    """(bin, n) of bins of equal width in the logarithm, from the least positive value (1 at least) to the greatest."""
    x = df.select(size.cast("double").alias("x")).where("x > 0")
    ends = x.agg(F.log10(F.greatest(F.lit(1.0), F.min("x"))).alias("a"), F.log10(F.max("x")).alias("b"))  # one row
    at = _bin(F.log10("x"), bins)
    return x.crossJoin(F.broadcast(ends)).where(F.log10("x") >= F.col("a")).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def upto_percentile_histogram(df: DataFrame, size: Column, share: float, bins: int) -> DataFrame:
    """(bin, n, median, upper_quartile) of the values up to a percentile, in equal bins from their least to their greatest.

    The percentiles are exact, and summed up by distinct value before they are merged.
    """
    x = df.select(size.cast("double").alias("x")).where("x is not null")
    marks = x.agg(F.percentile("x", F.array(F.lit(0.5), F.lit(0.75), F.lit(share))).alias("q"))  # one row
    kept = x.crossJoin(F.broadcast(marks)).where(F.col("x") <= F.col("q")[2])
    ends = kept.agg(F.min("x").alias("a"), F.max("x").alias("b"))  # one row
    at = _bin(F.col("x"), bins)
    return (
        kept.crossJoin(F.broadcast(ends))
        .groupBy(at.alias("bin"))
        .agg(F.count("*").alias("n"), F.first(F.col("q")[0]).alias("median"), F.first(F.col("q")[1]).alias("upper_quartile"))
    )


def crosstab(df: DataFrame, row: Column, column: Column) -> DataFrame:
    """(row, column, n) for every pair of values that occur, 0 where they never meet."""
    pairs = df.groupBy(row.alias("row"), column.alias("column")).agg(F.count("*").alias("n"))
    rows, columns = pairs.select("row").distinct(), pairs.select("column").distinct()
    # The result has a row for each pair of categories, so both sides are what a report can show; Spark chooses the join by their size.
    every = rows.crossJoin(columns)
    met = pairs.select(F.col("row").alias("r"), F.col("column").alias("c"), "n")
    return every.join(met, F.col("row").eqNullSafe(F.col("r")) & F.col("column").eqNullSafe(F.col("c")), "left").select("row", "column", F.coalesce("n", F.lit(0)).alias("n"))


def crosstab_totals(table: DataFrame) -> DataFrame:
    """A crosstab with the totals of its rows and columns, and their places by descending total, then by name."""
    rows = table.groupBy(F.col("row").alias("r")).agg(F.sum("n").alias("row_total"))
    columns = table.groupBy(F.col("column").alias("c")).agg(F.sum("n").alias("column_total"))
    rows = numbered(rows, "row_place", F.desc("row_total"), F.col("r")).withColumn("row_place", (F.col("row_place") + 1).cast("int"))
    columns = numbered(columns, "column_place", F.desc("column_total"), F.col("c")).withColumn("column_place", (F.col("column_place") + 1).cast("int"))
    return table.join(rows, F.col("row") == F.col("r")).join(columns, F.col("column") == F.col("c")).drop("r", "c")


def stacked(table: DataFrame, order: list[str]) -> DataFrame:
    """A crosstab with the places of its bars by descending total and of their parts: those of ``order`` first, others by name."""
    placed = crosstab_totals(table)
    known = F.array_position(F.array(*map(F.lit, order)), F.col("column"))
    return placed.withColumn("part_place", F.when(known > 0, known).otherwise(len(order) + 1)).drop("column_place", "column_total")


def with_default_rows(table: DataFrame, skip: str = "Unclassified") -> DataFrame:
    """A crosstab without the row of what has no label, unless it is the only one."""
    others = table.where(F.col("row") != skip)
    return others if not others.isEmpty() else table


def first_number(c: Column) -> Column:
    """The first signed decimal of a text, commas between digits aside; null without one or if it is negative."""
    plain = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?<=\d),(?=\d)", "")
    number = F.nullif(F.regexp_extract(plain, r"-?\d+(?:\.\d+)?", 0), F.lit("")).cast("double")
    return F.when(number >= 0, number)


def prepared(df: DataFrame) -> DataFrame:
    """An evidence table ready for analysis: missing columns empty, cells cleaned, numbers parsed, disease groups, and what is known of each population."""
    texts = ["Indication", "Intervention", "Intervention Type", "Comparator", "Outcome Direction", "Severity", "Occupation", "Social Status", "Treatment History"]

    def cell(name: str | None) -> Column:
        return clean(F.col(f"`{name}`").cast("string")) if name in df.columns else F.lit("")

    months = find_column(df.columns, "Follow-up Time (Months)") or find_column(df.columns, "Follow-up Months")
    age = find_column(df.columns, "Age [Mean_Age,SD_Age,Min_Age,Max_Age,N]", "Age [")
    people = find_column(df.columns, "Ethnicity Vector", "Ethnicity [")
    out = df.withColumns({n: cell(n) for n in texts})
    known = {"Gender": cell("Gender Male Proportion"), **{n: F.col(f"`{n}`") for n in ("Occupation", "Social Status", "Treatment History")}}
    return out.withColumns(
        {
            "Sample Size Numeric": number(cell("Sample Size")),
            "Follow-up Months Numeric": number(cell(months)),
            "Disease Subtypes": diseases(F.col("Indication")),
            "Intervention Text": F.trim(F.concat_ws(" ", F.col("Intervention"), F.col("Comparator"))),
            "Has Age": vector_nonzero(cell(age)),
            "Has Ethnicity": vector_nonzero(cell(people)),
            **{f"Has {n}": c != "" for n, c in known.items()},
            "Severity Is Mapped": F.col("Severity").rlike(r"^(?:\d|\[\d(?:,\d)*\])$"),
        }
    ).withColumn("Primary Disease Subtype", F.element_at("Disease Subtypes", 1))


def metrics(table: DataFrame) -> DataFrame:
    """One row on a prepared table: rows, sources, filled cells, quartiles of sizes and follow-up, severity, and what is known of populations."""
    size, months, severity = F.col("Sample Size Numeric"), F.col("Follow-up Months Numeric"), F.col("Severity")
    mapped = F.col("Severity Is Mapped")
    sources = F.array_sort(F.collect_set("Source File")) if "Source File" in table.columns else F.array().cast("array<string>")
    return table.agg(
        F.count("*").alias("row_count"),
        sources.alias("source_files"),
        *(F.count_if(F.col(n) != "").alias(f"non_empty_{n.lower()}") for n in ("Indication", "Intervention", "Comparator", "Severity")),
        F.median(size).alias("sample_size_median"),
        F.max(size).alias("sample_size_max"),
        F.median(months).alias("follow_up_median_months"),
        F.percentile(months, F.lit(0.75)).alias("follow_up_q3_months"),
        F.max(months).alias("follow_up_max_months"),
        F.count_if(mapped).alias("severity_mapped_rows"),
        F.count_if((severity != "") & ~mapped).alias("severity_retained_text_rows"),
        *(F.count_if(F.col(f"Has {n}")).alias(n.lower().replace(" ", "_")) for n in ("Age", "Gender", "Ethnicity", "Occupation", "Social Status", "Treatment History")),
    )


def run_counts(table: DataFrame, missing: str = "NaN") -> DataFrame:
    """One row of counters over an extraction table: records, structured ones, and those that have a field."""
    fields = ("pmid", "nct", "drugs", "indication", "p_values", "sample_size")
    return table.agg(F.count("*").alias("records"), F.count_if("is_structured").alias("structured"), *(F.count_if(F.col(f) != missing).alias(f) for f in fields))


def coverage(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """(field, n, percent): rows in which a test holds, one pass for all fields."""
    one = df.agg(F.count("*").alias("total"), *(F.count_if(t).alias(f"f{i}") for i, t in enumerate(fields.values())))
    pairs = F.array(*(F.struct(F.lit(name).alias("field"), F.col(f"f{i}").alias("n")) for i, name in enumerate(fields)))
    percent = F.when(F.col("total") > 0, F.floor(100 * F.col("p.n") / F.col("total"))).otherwise(0)
    return one.select(F.explode(pairs).alias("p"), "total").select("p.field", "p.n", percent.cast("long").alias("percent"))


def edges(df: DataFrame, labels: Column, other: Column, least: int, fallback: int = 40, skip: str = "Unclassified") -> DataFrame:
    """(label, other, n) of pairs met ``least`` times or more; if there are none, the ``fallback`` most frequent."""
    pairs = (
        df.select(F.explode(labels).alias("label"), clean(other).alias("other"))
        .where((F.col("label") != skip) & (F.col("other") != ""))
        .groupBy("label", "other")
        .agg(F.count("*").alias("n"))
    )
    strong = pairs.where(F.col("n") >= least)
    none = strong.agg(F.count("*").alias("strong_pairs"))  # one row
    ranked = pairs.orderBy(F.desc("n"), "label", "other").limit(fallback)
    return strong.unionByName(ranked.crossJoin(F.broadcast(none)).where("strong_pairs = 0").drop("strong_pairs"))


def weighted_degrees(found: DataFrame) -> DataFrame:
    """(node, side, degree, size): the weights of a node's edges, and how large it is drawn."""
    both = found.select(F.col("label").alias("node"), F.lit("label").alias("side"), "n").unionByName(
        found.select(F.col("other").alias("node"), F.lit("other").alias("side"), "n")
    )
    return both.groupBy("node", "side").agg(F.sum("n").alias("degree")).withColumn("size", 180 + 8 * F.sqrt("degree"))


def codebook(df: DataFrame, labels: Column, codes: str = "ABCDEF") -> DataFrame:
    """(id, label, frequency, code): labels by descending frequency, then by name; the first ones get a letter."""
    counted = df.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count("*").alias("frequency"))
    ranked = numbered(counted, "id", F.desc("frequency"), F.col("label")).withColumn("id", (F.col("id") + 1).cast("int"))
    return ranked.select("id", "label", "frequency", F.when(F.col("id") <= len(codes), F.substring(F.lit(codes), F.col("id"), F.lit(1))).otherwise("").alias("code"))
