"""Age expressions in years: what kind they are, how they were read, and the distribution that they stand for.

``parse`` gives a struct of the first reading that fits: mean and deviation,
median, mean, range, open bounds, one value, a term of the term table. Where a
text states no deviation or no other bound, the reading has a default one, and
``report`` tells what was stated from what was inferred. Null and the empty text
are ``missing``; what nothing fits is ``unknown``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.phrases import named, rows
from corvane.functions.text import clean, let, plain_signs

#: Bounds of what is open, and the deviation of what has none, as a share of the mean but one year at least.
OLDEST, YOUNGEST, SPREAD = 100.0, 0.0, 0.25
_P = named("age_expressions")
NUMBERS = ("lower", "upper", "center", "scale")
TEXTS = ("kind", "method", "stage", "confidence", "distribution")
#: Columns of ``report``, in order.
REPORT = (
    "age_detected_type", "age_norm_method", "age_norm_stage", "age_norm_confidence", "age_distribution_type", "age_norm_lower_years", "age_norm_upper_years",
    "age_norm_center_years", "age_norm_scale_years", "age_source_kind", "age_stage_major", "age_stage_detail", "age_original_unit", "age_lower_open", "age_upper_open",
    "age_requires_manual_review", "age_reported_lower_years", "age_reported_upper_years", "age_reported_center_years", "age_reported_scale_years",
    "age_inferred_lower_years", "age_inferred_upper_years", "age_inferred_center_years", "age_inferred_scale_years",
)


def normal(c: Column) -> Column:
    """Lower case, ASCII signs, single spaces."""
    out = F.coalesce(c, F.lit(""))
    for sign, ascii_ in (("–", "-"), ("—", "-"), ("−", "-"), ("≥", ">="), ("≤", "<="), ("±", " +/- ")):
        out = F.replace(out, F.lit(sign), F.lit(ascii_))
    return F.lower(clean(out))


def unit_factor(low: Column) -> Column:
    """Years in the one unit that a text names; 1 where it names none, years, or several."""
    year, month, week, day = (low.rlike(_P[x]) for x in ("YEARS", "MONTHS", "WEEKS", "DAYS"))
    one = sum((x.cast("int") for x in (year, month, week, day)), F.lit(0)) == 1
    return F.when(one & month, 1 / 12.0).when(one & week, 1 / 52.0).when(one & day, 1 / 365.0).otherwise(1.0)


def unit_label(low: Column) -> Column:
    """The unit named: months before weeks, days and years; empty for none."""
    out = F.lit("")
    for name in ("YEARS", "DAYS", "WEEKS", "MONTHS"):
        out = F.when(low.rlike(_P[name]), name.lower()).otherwise(out)
    return out


def _reading(kind, method="", stage="", confidence="", distribution="", lower=None, upper=None, center=None, scale=None) -> Column:
    texts = (kind, method, stage, confidence, distribution)
    numbers = (lower, upper, center, scale)

    def number(v) -> Column:
        return F.bround(v.cast("double"), 1) if isinstance(v, Column) else F.lit(v).cast("double")

    return F.struct(
        *((v if isinstance(v, Column) else F.lit(v)).alias(n) for n, v in zip(TEXTS, texts)),
        *(number(v).alias(n) for n, v in zip(NUMBERS, numbers)),
    )


def _width(lower: Column, upper: Column) -> Column:
    """The deviation of a uniform distribution."""
    return (upper - lower) / (12.0**0.5)


def _term(term: tuple[str, ...]) -> Column:
    """A row of the term table as a reading; what the table leaves out follows from its bounds."""
    _, kind, stage, low, high, family, mean, deviation, confidence, action = term
    lower, upper = (float(x) if x else None for x in (low, high))
    bounded = lower is not None and upper is not None
    center = float(mean) if mean else (lower + upper) / 2 if bounded else None
    scale = float(deviation) if deviation else (upper - lower) / 12**0.5 if bounded else None
    known = family.strip().lower()
    distribution = known if known in ("normal", "truncnorm", "fixed", "mixture") else "uniform" if bounded else ""
    rounded = [None if x is None else round(x, 1) for x in (lower, upper, center, scale)]
    detected = "age_term_manual_review" if action == "manual_review" else "age_term"
    return _reading(detected, f"mapping_library:{kind or 'term'}", stage, confidence, distribution, *rounded)


def terms(table: tuple[tuple[str, ...], ...] | None = None) -> Column:
    """The term table as a map from term to reading."""
    cells = []
    for term in table or rows("age_terms"):
        cells += [F.lit(" ".join(term[0].lower().split())), _term(term)]
    return F.create_map(*cells)


def parse(c: Column, table: tuple[tuple[str, ...], ...] | None = None) -> Column:
    """The first reading that fits."""

    def of(x: Column) -> Column:
        low, factor = x["low"], x["factor"]
        scaled = F.when(factor == 1.0, "").otherwise("_unit_scaled_to_years")

        def number(name: str, group: int = 1) -> Column:
            return F.nullif(F.regexp_extract(low, _P[name], group), F.lit("")).cast("double") * factor

        def method(name) -> Column:
            return F.concat(name if isinstance(name, Column) else F.lit(name), scaled)

        def fits(name: str) -> Column:
            return low.rlike(_P[name])

        def ends(a: Column, b: Column) -> tuple[Column, Column]:
            return F.greatest(F.lit(YOUNGEST), F.least(a, b)), F.greatest(F.lit(YOUNGEST), F.greatest(a, b))

        def spread(center: Column, scale: Column) -> tuple[Column, Column]:
            return F.greatest(F.lit(YOUNGEST), center - scale), center + scale

        def stated(kind: str) -> Column:
            center, scale = number(kind), number(kind, 2)
            return _reading("mean_sd", method("reported_mean_sd_to_normal_interval"), "", "high", "normal", *spread(center, scale), center, scale)

        ranged, lower, upper = fits("RANGE"), *ends(number("RANGE"), number("RANGE", 2))

        def central(kind: str, name: str, deviation: Column | None) -> Column:
            """A median or mean; a range that is stated takes the place of bounds by deviation."""
            center = number(name)
            default = F.greatest(F.lit(1.0), center * SPREAD)
            scale = default if deviation is None else F.coalesce(deviation, default)
            low_, high_ = spread(center, scale)
            told = F.lit(False) if deviation is None else deviation.isNotNull()
            how = F.when(ranged, f"{kind}_with_range_to_bounded_normal_interval").when(told, f"reported_{kind}_sd_to_normal_interval")
            how = how.otherwise(f"{kind}_default_sd_to_normal_interval")
            sure = F.when(ranged | told, "medium_high").otherwise("medium")
            return _reading(kind, method(how), "", sure, "normal", F.when(ranged, lower).otherwise(low_), F.when(ranged, upper).otherwise(high_), center, scale)

        def above(value: Column) -> Column:
            oldest = F.lit(OLDEST)
            return _reading("lower_bound", method("open_lower_bound_to_uniform_interval"), "", "low", "uniform", value, oldest, (value + oldest) / 2, _width(value, oldest))

        under = F.coalesce(number("BELOW"), number("BELOW", 2))
        below = _reading("upper_bound", method("open_upper_bound_to_uniform_interval"), "", "low", "uniform", F.lit(YOUNGEST), under, under / 2, _width(F.lit(YOUNGEST), under))
        one = number("SINGLE")
        single = _reading("single_value", method("single_value_to_point_interval"), "", "high", "fixed", one, one, one, F.lit(0.0))
        between = _reading("numeric_range", method("range_to_uniform_interval"), "", "high", "uniform", lower, upper, (lower + upper) / 2, _width(lower, upper))
        return (
            F.when(low == "", _reading("", ""))
            .when(fits("SIGNED"), stated("SIGNED"))
            .when(fits("SPELT"), stated("SPELT"))
            .when(fits("MEDIAN"), central("median", "MEDIAN", number("DEVIATION")))
            .when(fits("MEAN"), central("mean", "MEAN", None))
            .when(ranged, between)
            .when(fits("PLUS"), above(number("PLUS")))
            .when(fits("ABOVE"), above(F.coalesce(number("ABOVE"), number("ABOVE", 2))))
            .when(fits("BELOW"), below)
            .when(fits("SINGLE"), single)
            .otherwise(F.coalesce(F.try_element_at(terms(table), low), _reading("unknown", "unmapped", "", "very_low")))
        )

    return let(normal(c), lambda low: let(F.struct(low.alias("low"), unit_factor(low).alias("factor")), of))


def source_kind(parsed: Column) -> Column:
    """Where a reading comes from: a number, an open bound, a stage, a proxy, several stages, or nothing that can be used as it is."""
    kind, how, major = parsed["kind"], F.lower(parsed["method"]), F.split_part(parsed["stage"], F.lit("-"), F.lit(1))
    mixed = (major == "Mixed") | F.contains(how, F.lit("mixture"))
    proxy = major.isin("Contextual", "Noise") | F.contains(how, F.lit("contextual")) | F.contains(how, F.lit("education_proxy"))
    return (
        F.when((kind == "") & (how == ""), "missing")
        .when(kind.isin("numeric_range", "mean_sd", "mean", "median", "single_value"), "reported_numeric")
        .when(kind.isin("lower_bound", "upper_bound"), "reported_open_bound")
        .when(kind == "age_term_manual_review", "manual_review")
        .when((kind == "age_term") & mixed, "mixed_term")
        .when((kind == "age_term") & proxy, "contextual_proxy")
        .when(kind == "age_term", "mapped_stage")
        .otherwise("unmapped")
    )


def reported(parsed: Column) -> dict[str, Column]:
    """What the text itself states of lower, upper, center and scale; null for the rest."""
    kind, how = parsed["kind"], parsed["method"]
    central = kind.isin("mean", "median")
    with_range = central & F.contains(how, F.lit("_with_range_"))
    deviation = central & F.contains(how, F.lit("reported_")) & F.contains(how, F.lit("_sd_"))
    point = kind == "single_value"
    return {
        "lower": F.when(point, parsed["center"]).when(with_range | kind.isin("numeric_range", "lower_bound"), parsed["lower"]),
        "upper": F.when(point, parsed["center"]).when(with_range | kind.isin("numeric_range", "upper_bound"), parsed["upper"]),
        "center": F.when(point | central | (kind == "mean_sd"), parsed["center"]),
        "scale": F.when(point, F.lit(0.0)).when(deviation | (kind == "mean_sd"), parsed["scale"]),
    }


def report(df: DataFrame, value_col: str = "value", table: tuple[tuple[str, ...], ...] | None = None) -> DataFrame:
    """``df`` with the 24 columns of REPORT."""
    parsed = df.withColumn("_age", parse(F.col(value_col), table))
    p = F.col("_age")
    source, said = source_kind(p), reported(p)
    stage = p["stage"]
    cells = [
        *(p[n] for n in TEXTS),
        *(p[n] for n in NUMBERS),
        source,
        F.split_part(stage, F.lit("-"), F.lit(1)),
        F.regexp_extract(stage, "-(.*)$", 1),
        unit_label(normal(F.col(value_col))),
        (p["kind"] == "lower_bound").cast("int"),
        (p["kind"] == "upper_bound").cast("int"),
        source.isin("manual_review", "unmapped").cast("int"),
        *(said[n] for n in NUMBERS),
        *(p[n] for n in NUMBERS),
    ]
    return parsed.select(*(F.col(f"`{c}`") for c in df.columns), *(c.alias(n) for c, n in zip(cells, REPORT)))


def vector(parsed: Column) -> Column:
    """[mean, sd, low, high, n] with 0 for what is not stated; a term that is a stage has its bounds, and n never is known."""
    said, stage = reported(parsed), source_kind(parsed) == "mapped_stage"
    point = parsed["kind"] == "single_value"
    none = F.lit(None).cast("double")
    cells = (
        said["center"],
        said["scale"],
        F.when(point, none).when(stage, parsed["lower"]).otherwise(said["lower"]),
        F.when(point, none).when(stage, parsed["upper"]).otherwise(said["upper"]),
    )
    return F.array(*(F.coalesce(x, F.lit(0.0)) for x in cells), F.lit(0.0))


def below_one(text: Column, parsed: Column) -> Column:
    """Whether an age is an infant's, which the vector's years can't tell well."""
    said = reported(parsed)

    def known(name: str) -> Column:
        own = F.nullif(said[name], F.lit(0.0))
        return F.coalesce(own, F.nullif(parsed[name], F.lit(0.0)))

    words = F.lower(plain_signs(text)).rlike(r"\binfants?\b|\bnewborns?\b|\bneonates?\b")
    upper, lower = known("upper"), known("lower")
    return words | F.coalesce(upper < 1.0, F.lit(False)) | F.coalesce((lower < 1.0) & (upper <= 1.0), F.lit(False))
