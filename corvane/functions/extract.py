"""Field extractors over abstract texts. What is not found is null; lists are joined by ``"; "``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions import rules, tables
from corvane.functions.text import dedupe_by, let

# Where a match may begin: conditions that every match of the table's pattern meets, so that the long search is made there alone.
_NUMBER = r"(?=\d)(?<!\d)(?=\d++(?:\.\d*+)?+\s*+[gimnu])"
_SPAN = r"(?=\d)(?<!\d)(?=\d++[- ]?+(?:week|month|year))"
_ENDING = r"\b(?=[a-z]{8})(?=[a-z]{8,}+(?<=" + "|".join(sorted({x[-3:] for x in tables.DRUG_ENDINGS.partition("(?:")[2].partition(")")[0].split("|")})) + r")\b)"
_SENTENCE = r"(?<![^.])(?=[^.]*+\.)"

_DOSE, _ENDINGS = rules.at(_NUMBER, tables.DOSE), rules.at(_ENDING, tables.DRUG_ENDINGS)
_FOLLOW_UPS = [rules.at(_SPAN, p) if p.startswith(r"(\d+)") else p for p in tables.FOLLOW_UPS]
_SAMPLES = [rules.at(r"(?=n\s*+=)", p) if p.startswith("(?:[nN]") else rules.quick(p) for p in tables.SAMPLES]


def _joined(items: Column, limit: int) -> Column:
    return let(items, lambda x: F.when(F.size(x) > 0, F.array_join(F.slice(x, 1, limit), "; ")))


def registry_number(text: Column) -> Column:
    return F.concat(F.lit("NCT"), rules.first(text, r"NCT\s*(\d{6,8})", 1, flags=""))


def year(line: Column) -> Column:
    return rules.first(line, r"\b(?:19|20)\d{2}\b", flags="")


def drugs(text: Column, words: Column | None = None) -> Column:
    """Named treatments, then words with a drug's ending; the first five."""
    ending = F.filter(rules.found(text, _ENDINGS), lambda x: F.length(x) > 6)
    return _joined(dedupe_by(F.concat(rules.found(text, tables.DRUGS, words=words), ending), F.lower), 5)


def indication(title: Column, body: Column) -> Column:
    searched = F.concat_ws(" ", title, F.substring(body, 1, 500))
    return let(searched, lambda x: let(F.lower(x), lambda low: rules.first_match(x, tables.INDICATIONS, None, low)))


def objective(text: Column, words: Column | None = None) -> Column:
    names = tables.OBJECTIVES

    def of(counts: Column) -> Column:
        effect, mechanism = counts[0], counts[1]
        return F.when((effect == 0) & (mechanism == 0), names["other"]).when(mechanism > effect, names["mechanism"]).otherwise(names["efficacy"])

    return let(F.array(*(rules.count(text, p, words) for p in (tables.EFFICACY, tables.MECHANISM))), of)


def outcome(text: Column, words: Column | None = None) -> Column:
    names = tables.RESULTS

    def of(counts: Column) -> Column:
        good, bad, harm, safe = (counts[i] for i in range(4))
        silent = (good == 0) & (bad == 0)
        return (
            F.when(silent & (harm == 0) & (safe == 0), names["unknown"])
            .when(silent & (harm > 0) & (safe == 0), names["toxic"])
            .when(silent & (safe > 0) & (harm == 0), names["safe"])
            .when(good > bad, names["effective"])
            .otherwise(names["ineffective"])
        )

    return let(F.array(*(rules.count(text, p, words) for p in (tables.POSITIVE, tables.NEGATIVE, tables.HARMFUL, tables.HARMLESS))), of)


def dose(text: Column) -> Column:
    """Number and unit, the first four that differ."""
    kept = dedupe_by(rules.found(text, _DOSE), lambda x: F.regexp_replace(F.lower(x), r"\s+", ""))
    return _joined(F.transform(kept, lambda x: F.trim(x)), 4)


def follow_up(text: Column) -> Column:
    def of(span: Column) -> Column:
        n, unit = rules.first(span, r"\d+"), F.lower(rules.first(span, "week|month|year"))
        return F.concat(n, F.lit(" "), unit, F.when(n.cast("decimal(38,0)") > 1, "s").otherwise(""))

    return let(F.coalesce(*(rules.first(text, p) for p in _FOLLOW_UPS)), of)


def survival(text: Column) -> Column:
    return F.substring(F.trim(F.coalesce(*(rules.first(text, p) for p in tables.SURVIVAL))), 1, 100)


def progression_free(text: Column) -> Column:
    return F.substring(F.trim(F.coalesce(*(rules.first(text, p) for p in tables.PROGRESSION))), 1, 100)


def p_values(text: Column) -> Column:
    items = F.concat(*(F.transform(rules.found(text, p), lambda x: F.trim(x)) for p in tables.P_VALUES))
    return _joined(dedupe_by(items, lambda x: F.regexp_replace(F.lower(x), r"\s+", "")), 6)


def intervals(text: Column) -> Column:
    low, high = rules.found(text, tables.INTERVAL, 1), rules.found(text, tables.INTERVAL, 2)
    return _joined(F.zip_with(low, high, lambda a, b: F.concat(a, F.lit(" to "), b)), 4)


def ratios(text: Column) -> Column:
    return _joined(F.transform(rules.found(text, rules.quick(tables.RATIO)), lambda x: F.trim(x)), 4)


def sample_sizes(text: Column) -> Column:
    """Distinct counts from 5 to 99999, ascending, the first five."""
    counts = F.transform(F.concat(*(rules.found(text, p, 1) for p in _SAMPLES)), lambda x: x.cast("int"))
    fit = F.array_sort(F.array_distinct(F.filter(counts, lambda x: (x >= 5) & (x <= 99999))))
    return _joined(F.transform(fit, lambda x: x.cast("string")), 5)


def adverse_events(text: Column, words: Column | None = None) -> Column:
    """Named events, the first eight; else a sentence that speaks of some."""
    named = dedupe_by(rules.found(text, tables.EVENTS, words=words), lambda x: F.lower(F.trim(x)))
    sentence = F.substring(F.trim(rules.first(text, rules.at(_SENTENCE, tables.EVENT_SENTENCE))), 1, 150)
    return F.coalesce(_joined(named, 8), sentence)


def all_fields(text: Column, title: Column | None = None, words: Column | None = None) -> dict[str, Column]:
    """Every extractor over one text; a column of its ``rules.beginnings`` saves most of the search."""
    return {
        "nct": registry_number(text),
        "drugs": drugs(text, words),
        "indication": indication(F.lit("") if title is None else title, text),
        "objective": objective(text, words),
        "outcome": outcome(text, words),
        "dose": dose(text),
        "followup": follow_up(text),
        "os": survival(text),
        "pfs": progression_free(text),
        "p_values": p_values(text),
        "ci": intervals(text),
        "or_rr_hr": ratios(text),
        "sample_size": sample_sizes(text),
        "toxicity": adverse_events(text, words),
    }


# How much of a journal line, a title and the results the extraction table keeps.
JOURNAL, TITLE, RESULTS = 80, 120, 300
#: Columns of the extraction table, in order; lists of fixed length end where the table ends them.
ROW = (
    "index", "pmid", "year", "journal", "title", "doi", "is_structured", "nct", "objective", "drugs", "indication", "outcome", "dose", "followup", "os", "pfs",
    "p_values", "ci", "or_rr_hr", "sample_size", "toxicity", "results_snippet",
)


def table_row(record: dict[str, Column]) -> list[Column]:
    """A row of the extraction table, ``NaN`` for what is missing, from index, pmid, doi, journal, title, text, structured, results and methods.

    The outcome rests on the results where there are any, the dose on the methods first.
    """
    text, title, results = record["text"], record["title"], record["results"]
    said = F.coalesce(F.nullif(results, F.lit("")), text)
    found = all_fields(text, title) | {
        "outcome": outcome(said),
        "dose": dose(F.concat_ws(" ", record["methods"], text)),
        "index": record["index"],
        "pmid": record["pmid"],
        "doi": record["doi"],
        "year": year(record["journal"]),
        "journal": F.substring(record["journal"], 1, JOURNAL),
        "title": F.substring(title, 1, TITLE),
        "is_structured": record["structured"],
        "results_snippet": F.substring(said, 1, RESULTS),
    }
    return [(found[n] if n in ("index", "is_structured") else F.coalesce(F.nullif(found[n], F.lit("")), F.lit("NaN"))).alias(n) for n in ROW]
