"""Demographic fields of a study population: what a model said where it fits, else what rules find in the text.

Every field has a function of (model's value, source text). ``fields`` computes
a row at once, together with the short text that it rests on and whether the row
should go to a model. Null counts as the empty text, which gives empty fields.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import types as T

from corvane.functions.phrases import Rules, clip, column, compiled, distinct, named, render, rows, squeeze, structure, window

FIELDS = ("age", "gender", "ethnicity", "occupation", "social_status", "treatment_history")

# Words around a match that decide whether it is the population's own.
_OWNER = (
    r"(?:mothers?|fathers?|parents?|caregivers?|guardians?|famil(?:y|ies) members?|siblings?|relatives?|spouses?|partners?|"
    r"teachers?|providers?|staff|workers?|employees?|persons?|people|women|men|adults?)"
)
_YOUNG = r"young|preterm|preschool[- ]aged|school[- ]aged"
_STUDENT = r"college|university|high school"
_DEPENDENT = r"(?:children|child|adolescents?|teen(?:ager)?s?|youth|infants?|newborns?|neonates?|schoolchildren|students?)"
_OTHERS_AGE = compiled(rf"\b{_OWNER}\s+(?:of|with|for)\s+(?:(?:{_YOUNG}|{_STUDENT})\s+)?{_DEPENDENT}\s+aged?\b")
_OTHERS_LABEL = rf"\b{_OWNER}\s+(?:of\s+(?:(?:{_YOUNG}|{_STUDENT})\s+)?|(?:with|for)\s+(?:(?:{_YOUNG})\s+)?)%s\b"
_NO_AGE = compiled(
    r"\b(?:weeks?|months?|days?|hours?|minutes?|sessions?|visits?|follow[- ]up|postpartum|postnatal|gestation(?:al)?|postmenstrual|prenatal|trimester)\b"
)
_AGE_WORDS = compiled(
    r"\b(?:age|aged?|years?\s+old|year[- ]olds?|adults?|children|adolescents?|teen(?:ager)?s?|youth|elderly|geriatric|older adults?|young adults?|"
    r"schoolchildren|high school students|grade students|years?)\b"
)
_PROVIDERS = compiled(r"\b(?:provided|delivered|administered|led|facilitated|conducted|trained)\b.{0,120}\bby\b")
_MEN, _WOMEN = "(?:male|males|men|boys)", "(?:female|females|women|girls)"
_HAS_MEN, _HAS_WOMEN = compiled(rf"\b{_MEN}\b"), compiled(rf"\b{_WOMEN}\b")
_COUNTS = (
    (compiled(rf"(\d{{1,5}})\s*{_MEN}\b[^\d]{{0,40}}(\d{{1,5}})\s*{_WOMEN}\b"), 1, 2),
    (compiled(rf"(\d{{1,5}})\s*{_WOMEN}\b[^\d]{{0,40}}(\d{{1,5}})\s*{_MEN}\b"), 2, 1),
)
_MALE_SHARE, _FEMALE_SHARE = (compiled(rf"(\d{{1,3}}(?:\.\d+)?)\s*%\s*{x}\b") for x in (_MEN, _WOMEN))
_MATERNAL = compiled(r"\b(mothers?|pregnant|pregnancy|postpartum|postnatal|perinatal)\b")
_UNSAID = {"unknown", "n/a", "na", "not available", "not provided"}
_UNSAID_FIELD = {"", "not provided", "unknown", "n/a", "na"}
_COUNT_ONLY = compiled(r"(?:n\s*=\s*)?\d{1,5}|\d{1,5}\s+(?:participants?|patients?|subjects?|individuals?)")
_OLDEST = 120
_PEOPLE_ALONE = compiled(r"(?:adults?|women|men|children|adolescents?|older adults?|young adults?)")
_TARGETED_AGE = compiled(
    r"\b(?:age\s*(?:>=|=>|<=|=<|>|<)\s*\d+|aged?\s*(?:>=|=>|<=|=<|>|<)\s*\d+|at least\s+\d+\s*years?\s+old|\d+\s*-\s*to\s*\d+-year-olds?|\d+\+\b)\b"
)
_TARGETED_ETHNICITY = compiled(r"\b(?:non[- ]hispanic|han chinese|chinese han|pacific islanders?)\b")
_NON_HISPANIC = compiled(r"\bnon[- ]hispanic\b")
_FRAGMENT_END = re.compile(r"\s*\|\|\s*|(?<=[.;])\s+(?=[A-Z0-9])")
_LABEL_END = re.compile(r"\s*(?:\|\||;|,|\+)\s*")


class _Book:
    """The rule files, compiled once in each worker."""

    def __init__(self) -> None:
        self.names = named("signals_demographic")
        self.signal = {k.removesuffix("_SIGNAL"): compiled(p) for k, p in self.names.items()}
        self.scale = compiled(rf"\b{self.names['SCALE_NAME']}\b")
        self.ages = [(compiled(p), out, scan, need) for p, out, scan, need in rows("age_values")]
        self.descriptors = Rules("age_descriptors")
        self.ethnicities = [(compiled(p), p, label) for p, label in rows("ethnicities")]
        self.shares = [
            (compiled(form % p), label)
            for _, p, label in self.ethnicities
            for form in (r"(\d{1,3}(?:\.\d+)?)\s*%%\s*(?:%s)", r"(?:%s)\s*[:=]?\s*(\d{1,3}(?:\.\d+)?)\s*%%")
        ]
        self.occupations, self.status, self.treatments = (Rules(f"demographic_{x}") for x in ("occupations", "status", "treatment"))
        self.cleaning = Rules("demographic_cleaning", self.names)
        self.snippets: list[tuple[re.Pattern, bool]] = []
        for (pattern,) in rows("demographic_snippets"):
            if pattern == "*":
                self.snippets += [(p, False) for p, _, _ in self.ethnicities]
            else:
                self.snippets.append((compiled(self.names.get(pattern.strip("<>"), pattern)), pattern == "<<OCCUPATION_SIGNAL>>"))


@lru_cache(maxsize=1)
def _book() -> _Book:
    return _Book()


def _own(text: str, m: re.Match) -> bool:
    """Whether a number isn't the age of somebody whom the population looks after."""
    return not _OTHERS_AGE.search(window(text, m, 90, 20))


def _in_context(text: str, m: re.Match) -> bool:
    """Whether a range is one of ages."""
    around = window(text, m, 24, 24)
    if _NO_AGE.search(around) or not _own(text, m):
        return False
    return bool(_AGE_WORDS.search(around)) or squeeze(text) == squeeze(m[0])


_NEEDS = {"own": _own, "context": _in_context, "any": lambda text, m: True}


def _own_label(text: str, m: re.Match) -> bool:
    return not re.search(_OTHERS_LABEL % re.escape(m[0].strip().lower()), window(text, m, 80, 0), re.IGNORECASE)


def age(model: str, source: str) -> str:
    """An age as a range, a bound, mean and deviation, a median, a number, or a word for it; the source counts where the model is silent."""
    low = squeeze(model or source).lower()
    for sign, plain in (("卤", "+/-"), ("±", "+/-"), ("+-", "+/-"), ("–", "-"), ("—", "-")):
        low = low.replace(sign, plain)
    if not low or _COUNT_ONLY.fullmatch(low):
        return ""
    for pattern, out, scan, need in _book().ages:
        for m in pattern.finditer(low):
            if _NEEDS[need](low, m):
                return render(out, m)
            if scan == "first":
                break
    if label := _book().descriptors.first(low, _own_label):
        return clip(label, 40)
    return low if re.fullmatch(r"\d+\.\d+", low) and 0 < float(low) <= _OLDEST else ""


def percent(value: float) -> str:
    """One decimal, none where it is a zero."""
    rounded = round(float(value), 1)
    return f"{round(rounded)}%" if abs(rounded - round(rounded)) < 1e-9 else f"{rounded:.1f}%"


def share(text: str) -> str:
    """A percentage as it is written, of numbers up to one a hundredfold; empty for what is none."""
    try:
        number = float(squeeze(text).replace("%", ""))
    except ValueError:
        return ""
    number = number * 100 if 0 <= number <= 1 else number
    return percent(number) if 0 <= number <= 100 else ""


def gender_shares(text: str) -> tuple[str, str]:
    """Percentages of men and women: from their counts, else as stated."""
    for pattern, men, women in _COUNTS:
        if m := pattern.search(text):
            total = float(m[men]) + float(m[women])
            if total > 0:
                return percent(100 * float(m[men]) / total), percent(100 * float(m[women]) / total)
    return tuple(f"{m[1]}%" if (m := p.search(text)) else "" for p in (_MALE_SHARE, _FEMALE_SHARE))


def gender_label(men: bool, women: bool, men_share: str = "", women_share: str = "") -> str:
    """``45% Male + 55% Female``; without shares the bare words."""
    if men_share or women_share:
        parts = [f"{x} {who}" for x, who in ((men_share, "Male"), (women_share, "Female")) if x]
    else:
        parts = [who for here, who in ((men, "Male"), (women, "Female")) if here]
    return " + ".join(parts)


def gender(model: str, source: str, men: str = "", women: str = "", men_share: str = "", women_share: str = "") -> str:
    """The model's words, else its four separate answers, filled from the source."""
    said = squeeze(model)
    if said and said.lower() not in _UNSAID:
        label = gender_label(bool(_HAS_MEN.search(said)), bool(_HAS_WOMEN.search(said)), *gender_shares(said))
        return label or clip(said, 80)
    found = gender_shares(source)
    has_men = squeeze(men).lower() in ("male", "males") or bool(_HAS_MEN.search(source))
    has_women = squeeze(women).lower() in ("female", "females") or bool(_HAS_WOMEN.search(source)) or bool(_MATERNAL.search(source))
    return gender_label(has_men, has_women, share(men_share) or found[0], share(women_share) or found[1])


def ethnicity(model: str, source: str) -> str:
    """Labels with their percentages, all that are stated; else the labels alone."""
    low = squeeze(model or source).lower()
    stated = distinct(f"{m[1]}% {label}" for pattern, label in _book().shares for m in pattern.finditer(low))
    return " + ".join(stated or distinct(label for pattern, _, label in _book().ethnicities if pattern.search(low)))


def merged(*values: str, limit: int = 100) -> str:
    """Labels of several lists, of which one that holds another takes its place."""
    kept: list[str] = []
    for label in (x for v in values for x in map(squeeze, _LABEL_END.split(squeeze(v))) if x):
        low = label.lower()
        at = next((i for i, x in enumerate(kept) if low in x.lower() or x.lower() in low), None)
        if at is None:
            kept.append(label)
        elif low not in kept[at].lower():
            kept[at] = label
    return clip(" + ".join(distinct(kept)), limit)


def _not_by(text: str, m: re.Match) -> bool:
    """Whether somebody isn't named as who gives a treatment."""
    return not _PROVIDERS.search(window(text, m, 100, 30))


def found_occupation(text: str) -> str:
    return squeeze(_book().occupations.first(squeeze(text), _not_by))


def found_status(text: str) -> str:
    return merged(*_book().status.every(squeeze(text)), limit=120)


def found_treatment(text: str) -> str:
    return merged(*_book().treatments.every(squeeze(text)), limit=120)


def _field(find, others: tuple[str, str], limit: int):
    """A field of labels: those of the model's words, or the words themselves unless they belong to other fields, and those of the source."""

    def field(model: str, source: str) -> str:
        said = squeeze(model)
        own = find(said)
        if not own and not any(_book().signal[x].search(said) for x in others):
            own = clip(said, 100)
            own = "" if own.lower() in _UNSAID_FIELD else own
        return merged(own, find(source), limit=limit)

    return field


occupation = _field(found_occupation, ("SOCIAL_STATUS", "TREATMENT_HISTORY"), 100)
social_status = _field(found_status, ("OCCUPATION", "TREATMENT_HISTORY"), 120)
treatment_history = _field(found_treatment, ("OCCUPATION", "SOCIAL_STATUS"), 120)


def fragments(*texts: str) -> list[str]:
    return distinct(x for t in texts for x in _FRAGMENT_END.split(squeeze(t)))


def has_signal(text: str) -> bool:
    """Whether a text speaks of any trait of a population."""
    book = _book()
    names = ("AGE", "GENDER", "OCCUPATION", "SOCIAL_STATUS", "TREATMENT_HISTORY")
    low = squeeze(text).lower()
    return any(book.signal[n].search(low) for n in names) or any(p.search(low) for p, _, _ in book.ethnicities)


def _noisy(text: str, conduct: bool) -> bool:
    """Whether a phrase counts people, states scores or a risk or, if asked, tells of the study's conduct."""
    book = _book()
    return any(p.search(text) for p in (book.signal["SAMPLE_COUNT"], book.scale, book.signal["RISK"])) or (conduct and bool(book.signal["STUDY_NOISE"].search(text)))


def cleaned(fragment: str) -> str:
    return squeeze(_book().cleaning.rewrite(squeeze(fragment)))


def useful(text: str) -> bool:
    """Whether a cleaned phrase describes a population and nothing else."""
    if _PEOPLE_ALONE.fullmatch(text):
        return True
    if not text or not has_signal(text) or _noisy(text, conduct=False):
        return False
    return not (len(text) > 120 and _book().signal["STUDY_NOISE"].search(text)) and text.lower() not in ("depression", "major depressive disorder", "mdd")


def snippets(text: str) -> list[str]:
    """Parts of a sentence that tell of a population."""
    return distinct(m[0] for p, by_role in _book().snippets for m in p.finditer(text) if not by_role or _not_by(text, m))


def focus(raw: str) -> str:
    """The phrases of a raw population text that describe it, four at most."""
    kept: list[str] = []
    for fragment in fragments(raw):
        whole = cleaned(fragment)
        if useful(whole) and not _noisy(fragment, conduct=True):
            kept.append(clip(whole, 180))
        else:
            kept += [clip(x, 180) for x in map(cleaned, snippets(fragment)) if useful(x)]
    return " || ".join(distinct(kept[:4]))


def populated(row: dict[str, str]) -> int:
    return sum(bool(squeeze(row[k])) for k in FIELDS)


def complex_text(text: str) -> bool:
    """Whether rules alone may miss something: shares, ratios, much text or several coordinated parts."""
    whole = squeeze(text)
    parts = len(fragments(whole))
    coordinated = len(whole) > 50 or bool(re.search(r"\b(?:and|or)\b", whole, re.IGNORECASE))
    shares = re.search(r"\b\d+(?:\.\d+)?\s*%|\b\d+\s*[:/]\s*\d+\b", whole)
    return bool(whole) and (bool(shares) or len(whole) > 160 or (parts >= 2 and coordinated))


def missed(raw: str, row: dict[str, str]) -> bool:
    """Whether the raw text speaks of a trait that the rules left empty or may have taken wrongly."""
    low, signal = squeeze(raw).lower(), _book().signal
    if not low:
        return False
    for key, found in (("social_status", signal["SOCIAL_STATUS"]), ("treatment_history", signal["TREATMENT_HISTORY"]), ("age", _TARGETED_AGE)):
        if not row[key] and found.search(low):
            return True
    if not _TARGETED_ETHNICITY.search(low):
        return False
    return not row["ethnicity"] or ("hispanic/latino" in row["ethnicity"].lower() and bool(_NON_HISPANIC.search(low)))


def needs_model(raw: str, focused: str, row: dict[str, str]) -> bool:
    """Whether a row's rule result should be refined by a model."""
    whole = squeeze(raw)
    if not whole:
        return False
    if missed(whole, row):
        return True
    count, source = populated(row), " || ".join(distinct([focused, whole]))
    if count == 0:
        return bool(focused) or has_signal(whole)
    if count >= 2 or not complex_text(source):
        return False
    if re.search(r"\b\d+(?:\.\d+)?\s*%", source) and not (row["gender"] or row["ethnicity"]):
        return True
    return len(fragments(source)) >= 2


_KINDS = {"populated": T.IntegerType(), "needs_model": T.BooleanType()}
ROW = structure((*FIELDS, "focus", "populated", "needs_model"), _KINDS)


def row(raw: str, history: str, *model: str) -> dict:
    """All fields of a raw population text and treatment history; ``model`` has its answers to FIELDS, or is left out."""
    said = dict(zip(FIELDS, model or ("",) * len(FIELDS)))
    focused = focus(raw)
    source = " || ".join(distinct([focused, raw]))
    treatment_source = " || ".join(distinct([history, focused, raw]))
    out: dict = {
        "age": age(squeeze(said["age"]), source),
        "gender": gender(said["gender"], source),
        "ethnicity": ethnicity(squeeze(said["ethnicity"]), source),
        "occupation": occupation(said["occupation"], source),
        "social_status": social_status(said["social_status"], source),
        "treatment_history": treatment_history(said["treatment_history"], treatment_source),
    }
    return {**out, "focus": focused, "populated": populated(out), "needs_model": needs_model(raw, focused, out)}


def fields(raw: Column, history: Column, *model: Column) -> Column:
    """``row`` over columns, as one struct."""
    return column(row, ROW)(raw, history, *model)
