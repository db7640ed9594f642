"""Population rescue: rows without a population or severity take one from their record, from its text, or from a model.

Each step fills only what is still empty, and a status says which step did. The
rows of a record are brought together by grouped minima and joins on the record
id, so no record's rows have to be in one task at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import evidence
from corvane.functions.phrases import column

VALUES = ("population_raw", "severity")


def _filled(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) != ""


def first_values(rows: DataFrame, key: str = "record_id", order: str = "seq") -> DataFrame:
    """(key, shared_*): the first value that isn't empty, of each record."""
    return rows.groupBy(key).agg(*(F.min_by(v, F.when(_filled(F.col(v)), F.col(order))).alias(f"shared_{v}") for v in VALUES))


def contexts(records: DataFrame, key: str = "record_id", text: str = "rescue_context") -> DataFrame:
    """(key, cues, local_*): whether a record's text speaks of its population or severity, and what rules find in it."""
    t = F.col(text)
    return records.select(
        key,
        column(evidence.population_cue, "boolean")(t).alias("population_cue"),
        column(evidence.severity_cue, "boolean")(t).alias("severity_cue"),
        column(lambda x: evidence.population("", x), "string")(t).alias("local_population_raw"),
        column(lambda x: evidence.severity("", "", x), "string")(t).alias("local_severity"),
    )


def plan(rows: DataFrame, found: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, needs_population, needs_severity, no_cue) of the records that have rows."""
    state = rows.groupBy(key).agg(
        *(F.max(~_filled(F.col(v))).alias(f"open_{v}") for v in VALUES), *(F.max(_filled(F.col(v))).alias(f"some_{v}") for v in VALUES)
    )
    joined = state.join(found.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key"))

    def needs(v: str, cue: str) -> Column:
        return F.col(f"open_{v}") & (F.col(f"some_{v}") | _filled(F.col(f"local_{v}")) | F.col(cue))

    no_cue = ~F.col("population_cue") & ~F.col("severity_cue") & (F.col("open_population_raw") | F.col("open_severity"))
    return joined.select(
        key, needs("population_raw", "population_cue").alias("needs_population"), needs("severity", "severity_cue").alias("needs_severity"), no_cue.alias("no_cue")
    )


def plan_counts(planned: DataFrame) -> DataFrame:
    """One row: records examined, candidates, and how many need what."""
    return planned.agg(
        F.count("*").alias("records"),
        F.count_if(F.col("needs_population") | F.col("needs_severity")).alias("candidates"),
        F.count_if("needs_population").alias("population_candidates"),
        F.count_if("needs_severity").alias("severity_candidates"),
        F.count_if("no_cue").alias("no_cue_records"),
    )


def longer(old: Column, new: Column) -> Column:
    """Of two values the longer one, the old one of equals."""
    a, b = F.trim(F.coalesce(old, F.lit(""))), F.trim(F.coalesce(new, F.lit("")))
    return F.when(F.length(b) > F.length(a), b).otherwise(a)


def merged_answers(answers: DataFrame, key: str = "record_id") -> DataFrame:
    """(key, model_*): the longest value of each record's answers, the first by ``seq`` of equals."""
    best = (F.max_by(v, F.struct(F.length(F.trim(F.coalesce(v, F.lit("")))), -F.col("seq"))).alias(f"model_{v}") for v in VALUES)
    return answers.groupBy(key).agg(*best)


def needs_model(prompt: Column) -> Column:
    """Whether a record with a prompt still has open rows of something that its text speaks of; over filled rows with cues."""
    return (prompt != "") & ((~_filled(F.col("population_raw")) & F.col("population_cue")) | (~_filled(F.col("severity")) & F.col("severity_cue")))


def enrich(rows: DataFrame, found: DataFrame, answers: DataFrame | None = None, key: str = "record_id") -> DataFrame:
    """``rows`` with both values filled and their status, from the record's own rows, then its text, then a model's answers."""
    out = rows.join(first_values(rows, key).withColumnRenamed(key, "_a"), F.col(key) == F.col("_a"), "left").drop("_a")
    out = out.join(found.withColumnRenamed(key, "_b"), F.col(key) == F.col("_b"), "left").drop("_b")
    if answers is not None:
        out = out.join(merged_answers(answers, key).withColumnRenamed(key, "_c"), F.col(key) == F.col("_c"), "left").drop("_c")
    else:
        out = out.withColumns({f"model_{v}": F.lit("") for v in VALUES})

    def source(v: str) -> Column:
        """Which step fills a value."""
        return (
            F.when(_filled(F.col(v)), "own")
            .when(_filled(F.col(f"shared_{v}")), "broadcast")
            .when(_filled(F.col(f"local_{v}")), "local")
            .when(_filled(F.col(f"model_{v}")), "llm")
            .otherwise("")
        )

    out = out.withColumns({f"_from_{v}": source(v) for v in VALUES})
    filled = {
        v: F.when(F.col(f"_from_{v}") == "own", F.trim(F.col(v)))
        .when(F.col(f"_from_{v}") == "broadcast", F.trim(F.col(f"shared_{v}")))
        .when(F.col(f"_from_{v}") == "local", F.col(f"local_{v}"))
        .when(F.col(f"_from_{v}") == "llm", F.col(f"model_{v}"))
        .otherwise("")
        for v in VALUES
    }
    out = out.withColumns({**filled, "population_status": status(F.col("population_status"))})
    return out.select(*rows.columns, "_from_population_raw", "_from_severity")


def status(before: Column) -> Column:
    """How a row came to its population and severity; a row that no step touched keeps the status that it has."""
    people, severity = F.col("_from_population_raw"), F.col("_from_severity")

    def by(step: str) -> Column:
        return (people == step) | (severity == step)

    touched = by("broadcast") | by("local") | by("llm")
    new_severity = ~severity.isin("own", "")
    cue = F.coalesce(F.col("population_cue") | F.col("severity_cue"), F.lit(False))
    kept_population = F.when(~new_severity, "main_pass").when(by("llm"), "main_pass_plus_llm_severity").when(by("local"), "main_pass_plus_local_severity").otherwise("main_pass")
    new_population = (
        F.when(by("llm") & new_severity, "llm_rescue_population_and_severity")
        .when(by("llm"), "llm_rescue_population")
        .when(by("local") & new_severity, "local_rescue_population_and_severity")
        .when(by("local"), "local_rescue_population")
        .otherwise("record_broadcast")
    )
    severity_only = (
        F.when(severity == "own", "main_pass_severity_only")
        .when(by("llm"), "llm_rescue_severity_only")
        .when(by("local"), "local_rescue_severity_only")
        .otherwise("record_broadcast")
    )
    return (
        F.when(~touched & _filled(before), before)
        .when(people == "own", kept_population)
        .when(people != "", new_population)
        .when(severity != "", severity_only)
        .when(cue, "cue_present_unresolved")
        .otherwise("no_population_cue")
    )


def summary(enriched: DataFrame, key: str = "record_id") -> DataFrame:
    """One row of counters: rows that each step filled, and records by what became of them."""
    people, severity = F.col("_from_population_raw"), F.col("_from_severity")

    def counts(step: str) -> list[Column]:
        return [F.count_if(people == step).alias(f"{step}_population_rows"), F.count_if(severity == step).alias(f"{step}_severity_rows")]

    return enriched.agg(
        F.count_distinct(key).alias("records"),
        F.count("*").alias("rows"),
        F.count_if((people == "broadcast") | (severity == "broadcast")).alias("broadcast_rows"),
        *counts("local"),
        *counts("llm"),
        F.count_distinct(F.when((people == "llm") | (severity == "llm"), F.col(key))).alias("llm_records_applied"),
        F.count_distinct(F.when(F.col("population_status") == "cue_present_unresolved", F.col(key))).alias("unresolved_records"),
        F.count_distinct(F.when(F.col("population_status") == "no_population_cue", F.col(key))).alias("no_cue_records"),
    )


def covered(rows: DataFrame, index: str = "source_index") -> DataFrame:
    """(record_id) of the records that rows name by a number, each once."""
    number = column(evidence.source_index, "string")(F.col(index))
    return rows.select(number.alias("_n")).where(F.col("_n").rlike(r"^\d+$")).select(F.col("_n").cast("long").alias("record_id")).distinct()
