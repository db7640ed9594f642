"""Standardised values: counts, durations, severity and status codes, proportions, shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions import rules, tables
from corvane.functions.text import bracketed, clean, fragments, let, merge_labels, plain_signs

# How units of time convert to months.
DAYS_PER_MONTH, WEEKS_PER_MONTH, MONTHS_PER_YEAR = 30.0, 4.0, 12.0
_DURATION = r"(\d+(?:\.\d+)?(?:\s*(?:to|-)\s*\d+(?:\.\d+)?)?)\s*(day|days|week|weeks|month|months|year|years)"


def sample_digits(c: Column) -> Column:
    """All digits of a text as one number (``30-40`` gives 3040); null without any."""
    return F.regexp_replace(clean(c), "[^0-9]", "").try_cast("long")


def follow_up_months(c: Column) -> Column:
    """The longest duration in months, of a range its upper end; null without any."""
    text = F.lower(plain_signs(c))

    def months(amount: Column, unit: Column) -> Column:
        upper = F.regexp_extract(amount, r"(\d+(?:\.\d+)?)$", 1).cast("double")
        return (
            F.when(unit.startswith("day"), upper / DAYS_PER_MONTH)
            .when(unit.startswith("week"), upper / WEEKS_PER_MONTH)
            .when(unit.startswith("month"), upper)
            .otherwise(upper * MONTHS_PER_YEAR)
        )

    return let(text, lambda low: F.array_max(F.zip_with(rules.found(low, _DURATION, 1), rules.found(low, _DURATION, 2), months)))


def severity_codes(c: Column) -> Column:
    """Codes of all phrases; else of the first scale; else of the words; descending, without repeats."""

    def of(codes) -> Column:
        return F.array(*(F.lit(x) for x in codes))

    def codes_of(low: Column) -> Column:
        none = F.array().cast("array<int>")
        phrases = F.flatten(F.array(*(F.when(low.rlike(f"(?i){p}"), of(codes)).otherwise(none) for p, codes in tables.SEVERITY_PHRASES)))
        scale = none
        for pattern, codes in reversed(tables.SEVERITY_SCALES):
            scale = F.when(low.rlike(f"(?i){pattern}"), of(codes)).otherwise(scale)
        words = F.array_compact(F.array(*(F.when(low.rlike(rf"\b{w}\b"), F.lit(code)) for w, code in tables.SEVERITY_WORDS)))
        return F.reverse(F.array_sort(F.array_distinct(let(phrases, lambda x: F.when(F.size(x) > 0, x).otherwise(let(scale, lambda y: F.when(F.size(y) > 0, y).otherwise(words)))))))

    return let(F.lower(plain_signs(c)), codes_of)


def severity_cell(c: Column) -> Column:
    """Severity codes as ``2`` or ``[3,2]``; a text that no rule maps stays as it is."""
    return let(severity_codes(c), lambda x: F.when(F.size(x) > 0, bracketed(x)).otherwise(clean(c)))


def male_proportion(c: Column) -> Column:
    """Share of men: from their percentage, else the women's, else the bare word; null otherwise."""

    def of(low: Column) -> Column:
        men = rules.first(low, r"(\d+(?:\.\d+)?)\s*%\s*male", 1).cast("double")
        women = rules.first(low, r"(\d+(?:\.\d+)?)\s*%\s*female", 1).cast("double")
        return F.coalesce(men / 100, 1 - women / 100, F.when(low == "male", 1.0).when(low == "female", 0.0))

    return let(F.lower(plain_signs(c)), of)


def social_codes(c: Column) -> Column:
    """Codes 1 to 6 of a social status, ascending; 6 where no other fits, none for an empty text."""

    def of(low: Column) -> Column:
        hits = [F.when(low.rlike(f"(?i){p}"), F.lit(code)) for p, code in tables.SOCIAL_CODES]
        hits.append(F.when(~low.rlike(f"(?i){tables.SOCIAL_CODES[2][0]}") & low.rlike(f"(?i){tables.OTHER_DISEASE}"), F.lit(5)))
        codes = let(F.array_compact(F.array(*hits)), lambda x: F.when(F.size(x) == 0, F.array(F.lit(6))).otherwise(x))
        return F.when(low == "", F.array().cast("array<int>")).otherwise(codes)

    return let(F.lower(clean(c)), of)


def ethnicity_shares(c: Column) -> Column:
    """(label, share) of each ethnicity named, shares summing to 1; those without a percentage split what is left."""
    zero = F.lit(0.0)

    def part(s: Column) -> Column:
        return F.struct(
            rules.first_match(F.lower(s), tables.ETHNICITIES).alias("label"),
            F.nullif(F.regexp_extract(s, r"(\d+(?:\.\d+)?)\s*%", 1), F.lit("")).cast("double").alias("percent"),
        )

    def whole(text: Column) -> Column:
        label = rules.first_match(F.lower(text), tables.ETHNICITIES)
        return F.filter(F.array(F.struct(label.alias("label"), F.lit(1.0).alias("share"))), lambda x: x["label"] != "")

    def several(named: Column) -> Column:
        weighed = F.aggregate(named, zero, lambda a, x: a + F.coalesce(x["percent"] / 100, zero))
        open_ = F.size(F.filter(named, lambda x: x["percent"].isNull()))

        def spread(known: Column) -> Column:
            left = F.when(known["open"] == F.size(named), 1.0).otherwise(F.greatest(zero, 1 - known["weighed"]))
            rest = F.when(known["open"] == 0, zero).otherwise(left / known["open"])

            def shares(sums: Column) -> Column:
                total = sums["rest"] * known["open"] + known["weighed"]

                def share(label: Column) -> Column:
                    own = F.aggregate(F.filter(named, lambda x: x["label"] == label), zero, lambda a, x: a + F.coalesce(x["percent"] / 100, sums["rest"]))
                    return F.struct(label.alias("label"), F.when(total > 0, own / total).otherwise(own).alias("share"))

                return F.transform(F.array_distinct(F.transform(named, lambda x: x["label"])), share)

            return let(F.struct(rest.alias("rest")), shares)

        return let(F.struct(weighed.alias("weighed"), open_.alias("open")), spread)

    def of(text: Column) -> Column:
        parts = F.transform(F.split(text, r"\s*\+\s*|\s*\|\|\s*|;"), part)
        return let(F.filter(parts, lambda x: x["label"] != ""), lambda named: F.when(F.size(named) > 0, several(named)).otherwise(whole(text)))

    return let(plain_signs(c), of)


def occupations(c: Column) -> Column:
    """Occupations named, in the rules' order and without repeats; else the text itself, up to 80 characters and unless it tells of something else."""

    def of(text: Column) -> Column:
        short = (text != "") & (F.length(text) <= 80) & ~text.rlike("(?i)" + tables.NO_OCCUPATION)
        other = F.when(short, F.array(text)).otherwise(F.array().cast("array<string>"))
        return let(F.array_distinct(rules.all_matches(F.lower(text), tables.OCCUPATIONS)), lambda named: F.when(F.size(named) > 0, named).otherwise(other))

    return let(clean(c), of)


def occupation_text(c: Column) -> Column:
    return merge_labels(occupations(c), 100)


def _labels(texts: tuple[Column, ...], table: list) -> Column:
    """Labels of all fragments of several texts, merged."""
    parts = fragments(F.concat_ws(" || ", *(F.coalesce(x, F.lit("")) for x in texts)))
    found = F.flatten(F.transform(parts, lambda x: let(F.lower(plain_signs(x)), lambda low: rules.all_matches(low, table))))
    return merge_labels(found)


def social_text(*texts: Column) -> Column:
    return _labels(texts, tables.SOCIAL_TEXTS)


def treatment_text(*texts: Column) -> Column:
    return _labels(texts, tables.TREATMENT_HISTORIES)


def treatment_history(c: Column) -> Column:
    return let(F.lower(plain_signs(c)), lambda low: F.array_distinct(rules.all_matches(low, tables.TREATMENT_HISTORIES)))


def diseases(c: Column) -> Column:
    """All disease groups that a text names; ``Unclassified`` for none."""
    hits = let(F.lower(clean(c)), lambda low: rules.all_matches(low, tables.DISEASES))
    return let(hits, lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(F.lit(tables.UNCLASSIFIED))))


def fixed(c: Column, digits: int = 2) -> Column:
    """A number with so many decimals; empty for null."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f", c.cast("double"))).otherwise("")


def short_number(c: Column) -> Column:
    """A number without zeros after its point; ``0`` for null."""
    return F.when(c.isNotNull(), F.regexp_replace(F.regexp_replace(F.format_string("%.2f", c.cast("double")), r"0+$", ""), r"\.$", "")).otherwise("0")


def vector_nonzero(c: Column) -> Column:
    """Whether a bracketed list has a number that isn't zero; what is no number counts as zero."""
    text = clean(c)
    parts = F.split(F.regexp_replace(text, r"^\[+|\]+$", ""), ",")
    some = F.exists(parts, lambda x: F.abs(F.coalesce(F.trim(x).try_cast("double"), F.lit(0.0))) > 1e-12)
    return text.startswith("[") & text.endswith("]") & some


def severity_digits(c: Column) -> Column:
    """Codes in a severity cell such as ``2`` or ``[3,2]``."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\d"), F.lit(0)), lambda x: x.cast("int"))
