"""Fields of an extracted arm pair: a model's words where they fit, else what the record says.

``normalized`` computes all fields of a row from the model's answer and three
contexts: the record's whole text, what it says of its population, and its
results. Every field is a function of its own, too. Null counts as the empty
text. Text with nothing to find gives the empty text, but for the indication of
a text on depression and the direction of an outcome, which always have a value.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column

from corvane.functions import arms
from corvane.functions.phrases import Rules, clip, column, compiled, distinct, expand, named, rows, structure, window

# Clean-up of signs, windows, lists of words, limits.
_SIGNS = (("naïve", "naive"), ("naïve", "naive"), ("ï", "i"), ("–", "-"), ("—", "-"), ("−", "-"), ("‑", "-"))
_SENTENCE_END = re.compile(r"\s*\|\|\s*|(?<=[.;?!])\s+(?=[A-Z0-9])")
_EVIDENCE_END = re.compile(r"(?<=[.!?])\s+(?=[A-Z0-9])")
_COUNT = r"\d{1,5}(?:,\d{3})*"
_PEOPLE = "(?:participants|patients|subjects|adults|women|men|children|adolescents|individuals)"
_BARE_COUNT = (
    compiled(rf"^({_COUNT})$"),
    compiled(rf"^n\s*=\s*({_COUNT})$"),
    compiled(rf"^({_COUNT})\s*{_PEOPLE}\b"),
    compiled(rf"^(?:included|enrolled|recruited|randomi[sz]ed)\s+({_COUNT})\b"),
)
_STATED_COUNT = (
    compiled(rf"\btotal\s+(?:sample|participants?|patients?|subjects?)\s*(?:size)?\s*[:=]?\s*({_COUNT})\b"),
    compiled(rf"\bn\s*=\s*({_COUNT})\b"),
    compiled(rf"\b(\d{{2,5}}(?:,\d{{3}})*)\s+{_PEOPLE}\b"),
    compiled(r"\b(?:included|enrolled|recruited|randomi[sz]ed)\s+(\d{2,5}(?:,\d{3})*)\b"),
)
_ARM_COUNT = compiled(rf"\bn\s*=\s*({_COUNT})\b")
_SUBGROUP = ("completed", "completion", "retested", "healthy", "depressed", "remitted", "non-remitted")
_NOT_ARMS = (*_SUBGROUP, "cohort", "replication", "follow", "year", "month", "week", "day", "/")
_NOT_TOTAL = (*_SUBGROUP, "follow-up", "followed-up")
_VERSUS = (" versus ", " vs ", " compared with ", " compared to ")
_UNITS = "(?:day|days|week|weeks|month|months|year|years)"
_SPAN = r"\d+(?:\.\d+)?(?:\s*(?:to|-)\s*\d+(?:\.\d+)?)?"
_DURATION = compiled(rf"\b({_SPAN})\s*(?:-| )?\s*({_UNITS})\b")
_TEXT_DURATION = rf"{_SPAN}\s*(?:-| )?\s*{_UNITS}"
_FOLLOW_UPS = tuple(
    compiled(p % _TEXT_DURATION)
    for p in (
        r"\bfollow[- ]?up(?:\s*(?:period|duration|time))?\s*(?:of|for|at|was|is|:)?\s*(%s)\b",
        r"\b(%s)\s*(?:of\s*)?follow[- ]?up\b",
        r"\bfollowed\s+(?:participants|patients|subjects)?\s*(?:for)?\s*(%s)\b",
        r"\bpost[- ]?(?:treatment|intervention)\s*(?:follow[- ]?up)?\s*(?:at|of|for)?\s*(%s)\b",
        r"\b(%s)\s*post[- ]?(?:treatment|intervention)\b",
    )
)
_NUMBER_WORDS = "one two three four five six seven eight nine ten eleven twelve".split()
_DAYS = {"day": 1, "week": 7, "month": 30, "year": 365}
_PEOPLE_HINT = compiled(
    r"\b(individuals?|persons?|people|patients?|participants?|subjects?|adults?|children|adolescents?|schoolchildren|women|men|workers?|employees?|nurses?|students?|"
    r"veterans?|clients?|mothers?|fathers?|survivors?|immigrants?|refugees?|caregivers?)\b"
)
_HINTS = (compiled(r"\b(?:in|among|for)\s+([^.;:]{3,180})$"), compiled(r"\b(?:in|among|for)\s+([^.;:]{3,180})(?=[,;.]|$)"))
_NO_CONDITION = compiled(r"\b(?:symptoms?|disorder|syndrome|patients?|individuals?|participants?)\b")
_COORDINATED = (compiled(r"([^,;:.]{2,80})\s+(?:and|or|/)\s+([^,;:.]{2,80})"), compiled(r"([^,;:.]{2,80})\s+with\s+([^,;:.]{2,80})"))
_SUBTYPES = {f"{x} depression" for x in ("melancholic", "atypical", "psychotic", "catatonic", "seasonal pattern", "peripartum", "anxious distress")}
_NO_TARGET = ("randomized", "depression", "study", "trial", "patients", "psychotherapy", "exercise", "session", "weekly")
_TARGETS = ("receptor", "pathway", "axis", "transporter", "inflammation", "bdnf", "nmda", "gaba", "5-ht", "seroton", "dopamin", "glutamat", "hpa", "trkb", "d2", "d3", "mao")
_SAID = {
    "Positive": {"positive", "improvement", "improved", "increase", "better"},
    "Neutral": {"neutral", "no difference", "no change", "no significant difference", "no effect"},
    "Negative": {"negative", "worsening", "worsened", "worse", "decrease"},
}
_MIXED = ("mixed result", "mixed results", "mixed finding", "mixed findings", "inconclusive", "unclear")
UNDECIDED = "Mixed or Unknown"
_RESULT_WORDS = (
    "significant", "improved", "improvement", "reduced", "reduction", "decreased", "lower", "higher", "non-inferior", "no significant", "did not differ", "comparable",
    "similar", "favored", "favour", "response", "remission", "effective", "efficacy",
)
_COMPARED = ("compared", "versus", "vs ", "group", "between-group")
#: Characters of a result sentence, and the score from which one is taken.
EVIDENCE, ENOUGH = 420, 2
_PHASE = compiled(r"\bphase\s+((?:[1-4]|i{1,3}|iv)(?:/(?:[1-4]|i{1,3}|iv))?)\b")
# Phrases on a population.
_GROUP = compiled(
    r"(?:[A-Za-z][A-Za-z'/-]*\s+){0,3}(?:adults?|women|men|children|adolescents?|students?|workers?|employees?|veterans?|caregivers?|volunteers?|outpatients?|inpatients?|"
    r"undergraduates?|survivors?|soldiers?|families?|infants?|toddlers?)"
)
_GROUP_ALONE = compiled(r"(?:adults?|women|men|children|adolescents?|older adults?|young adults?|infants?|toddlers?)")
_SURVIVORS = compiled(r"(?:[A-Za-z][A-Za-z'/-]*\s+){0,2}survivors?")
_ILLNESS = compiled(r"\b(?:depression|depressive|disorder|mdd|cancer|epilepsy|diabetes|fracture)\b")
_CONDUCT = compiled(r"\b(?:study|trial|randomi[sz]ed|double-blind|placebo-controlled|study protocol|trial protocol|data from|results? from)\b")
_CONTEXTUAL = compiled(
    r"\b(?:with|who|from|in|suffering from|exposed to|presenting|meeting|diagnosed with|history of|admitted for|admitted to|on hemodialysis|working in|remitted from|"
    r"experiencing|lasting|partial responders? to)\b"
)
_GIVEN_BY = compiled(r"\b(?:delivered by|administered by|provided by)\b")
_VETERANS_AFFAIRS = compiled(r"\b(?:veterans affairs|department of veteran affairs)\b")
_STATES_TOO_VAGUE = {
    "untreated", "currently untreated", "currently receiving treatment", "currently in treatment", "treatment-free", "drug-free", "medication-free", "antidepressant-free",
    "off medication",
}
_STATES_ALONE = {
    "previously untreated", "treatment-naive", "drug-naive", "medication-naive", "antidepressant-naive", "psychotherapy-naive", "unmedicated", "hitherto untreated",
    "none of whom were currently receiving treatment",
}
_NEVER = {
    "medication free", "medication-free", "prior treatment", "history of treatment", "mixed", "alcohol use", "substance use", "depression", "major depressive disorder", "mdd",
}
_STRONG_START = (
    r"\b(?:previously untreated|currently untreated|treatment[- ]naive|drug[- ]naive|medication[- ]naive|antidepressant[- ]naive|psychotherapy[- ]naive|"
    r"aged?\s+(?:between\s+)?\d|mean age|median age|average age|"
    r"\d+(?:\.\d+)?%\s*(?:female|male|women|men|african[- ]american|black|white|caucasian|asian|hispanic|latino|latina|indigenous|native american|multiracial|mixed[- ](?:race|ethnicity))|"
    r"(?:pregnant|postpartum|perinatal|orphaned|low[- ]income|older adults?|young adults?|adolescents?|children|schoolchildren|women|men|students?|workers?|caregivers?|"
    r"veterans?|residents?|clients?|consumers?)\b(?:\s+(?:with|who|aged|from|living|presenting|in)\b)?)"
)
_COUNTED_START = r"\b(?:(?:a total of|of the)\s+)?(?:\d{1,5}(?:,\d{3})*|<<WRITTEN_NUMBER>>)\s+(?:[A-Za-z0-9'/-]+\s+){0,4}<<POPULATION_ENTITY_NOUN>>\b"
_CAPITALS = r"[A-Z][A-Za-z0-9'/-]+(?:\s+[A-Z][A-Za-z0-9'/-]+)"
_PLAIN_PEOPLE = compiled(r"(?:adults?|adult|women|men|patients?|participants?|subjects?|outpatients?|inpatients?)")
_DIAGNOSED = compiled(r"\b(?:diagnosed with|with)\s+(?:major depressive disorder|mdd|depression|depressive symptoms?|unipolar depressive disorder)\b")
_THERAPIST = r"|\btherapists?\b|\bpsychiatrist services?\b"
_WAITING = compiled(r"\b(?:potentially reach|shortening waiting lists|could increase the efficacy)\b")
_GOES_ON = compiled(r"^(?:with|who|aged?|ages?|diagnosed|meeting|from|in)\b")
_NO_ANCHOR = compiled(r"^(?:recruited|enrolled|selected|included|randomi[sz]ed|allocated|assigned|at|from)\b")
_NO_CONTEXT = compiled(r"^(?:results?|conclusions?)\b|\b(?:intervention group|control group|were provided with|were asked to)\b")
_NEEDS_SUPPORT = compiled(
    r"(?:adults?|older adults?|young adults?|elderly|outpatients?|inpatients?|patients?|participants?|subjects?|treatment-naive|drug-naive|medication-naive|"
    r"antidepressant-naive|psychotherapy-naive|previously untreated|currently untreated|treatment-free|drug-free|medication-free|antidepressant-free)"
)
_SHORT_SUPPORT = compiled(
    r"\b(?:adults?|older adults?|young adults?|elderly|outpatients?|inpatients?|patients?|participants?|subjects?|treatment[- ]naive|drug[- ]naive|medication[- ]naive|"
    r"antidepressant[- ]naive|psychotherapy[- ]naive|previously untreated|currently untreated)\b"
)
_GENERIC = compiled(
    r"(?:adults?|adult|older adults?|older patients?|young adults?|elderly|participants?|patients?|subjects?|women|men|boys|girls|adolescents?|children|outpatients?|"
    r"inpatients?|workers?|employees?|students?|veterans?)"
)
_AGES = compiled(
    r"\b(?:mean age|median age|average age|aged?\s+(?:between\s+)?\d|\d+(?:\.\d+)?\s*(?:-|to)\s*\d+(?:\.\d+)?\s*years?|\d+(?:\.\d+)?\s*years?\s+or older)\b"
)
_AGE_WORDS = compiled(r"\b(?:older adults?|young adults?|adolescents?|children|schoolchildren|elderly|geriatric|late-life)\b")
#: Points of a phrase for what it tells; the last ones speak against it.
_POINTS = (("GENDER", 4), ("ETHNICITY", 4), ("OCCUPATION", 3), ("SOCIAL_STATUS", 3), ("TREATMENT_HISTORY", 3), ("SETTING", 2), ("RELATION", 2), ("CLINICAL_POPULATION_CONTEXT", 1))
_OTHER_POINTS = (
    (compiled(r"\b(?:county|school|clinic|hospital|community|veterans?)\b"), 1),
    (compiled(r"\b(?:clinically referred|participating|eligible|study|trial)\b"), -2),
    (compiled(r"^(?:mixed|multiracial)$"), -2),
)
#: Characters of a phrase, and phrases that are kept.
PHRASE, PHRASES = 180, 3
_SEVERITY_WORDS = compiled(
    r"\b(?:mild|moderate|severe)(?:\s*(?:to|-)\s*(?:moderate|severe))?\b|\b(?:subthreshold|subsyndromal|residual symptoms?|remitted|partially remitted)\b"
)


class _Book:
    """The rule files, compiled once in each worker."""

    def __init__(self) -> None:
        self.names = named("signals_evidence")
        self.signal = {k.removesuffix("_SIGNAL"): compiled(p) for k, p in self.names.items()}
        self.scale = compiled(rf"\b{self.names['SCALE_NAME']}\b")
        self.conditions, self.comorbidities, self.forms = Rules("conditions"), Rules("comorbidities"), Rules("depression_forms")
        self.depression, self.schedule = ([r[0] for r in rows(x)] for x in ("depression_terms", "schedule_terms"))
        self.outcome = {k: [r[0] for r in rows(f"outcome_{k}")] for k in ("neutral", "positive", "negative")}
        self.outcome_context = {k: Rules(f"outcome_{k}_context") for k in ("positive", "negative")}
        self.purpose, self.evidence_purpose = Rules("population_purpose"), Rules("evidence_purpose")
        self.snippets, self.severity = Rules("population_snippets", self.names), Rules("severity_traces", self.names)
        self.counts, self.cleaning, self.opening = (Rules(x, self.names) for x in ("population_counts", "population_cleaning", "evidence_cleaning"))
        self.starts = [
            (compiled(expand(_STRONG_START, self.names)), re.compile(rf":|{_CAPITALS}{{3,}}")),
            (compiled(expand(_COUNTED_START, self.names)), re.compile(rf":|{_CAPITALS}{{2,}}")),
        ]
        self.by_provider = compiled(f"(?:{self.names['PROVIDER_CONTEXT']}{_THERAPIST})")


@lru_cache(maxsize=1)
def _book() -> _Book:
    return _Book()


def tidy(text: object) -> str:
    """ASCII dashes, single spaces, no separators at the ends."""
    out = str(text or "")
    for sign, plain in _SIGNS:
        out = out.replace(sign, plain)
    return re.sub(r"\s+", " ", out).strip(" ;|,-")


def _clip(text: str, limit: int) -> str:
    return clip(tidy(text), limit, " ,;:-")


def fragments(*texts: str) -> list[str]:
    """Sentences and parts between bars, each once."""
    return distinct((x for t in texts for x in _SENTENCE_END.split(tidy(t))), tidy)


def source_index(raw: str) -> str:
    """The number that a model gave for a record: all digits, else the first number, else its words."""
    text = tidy(raw)
    m = None if text.isdigit() else re.search(r"\b(\d+)\b", text)
    return m[1] if m else text


def phase(*texts: str) -> str:
    """``Phase 2/3`` as the texts first name it."""
    m = _PHASE.search(" ".join(tidy(x) for x in texts if x))
    return f"Phase {m[1].upper()}" if m else ""


# Numbers of people.


def _digits(text: str) -> str:
    found = re.sub(r"\D", "", text)
    return str(int(found)) if found else ""


def bare_count(text: str) -> str:
    """The number of a text that says little else."""
    text = tidy(text)
    return next((_digits(m[1]) for p in _BARE_COUNT if (m := p.search(text))), "")


def arms_total(text: str) -> str:
    """The sum of two to four arms' numbers, unless they are of subgroups or times."""
    text = tidy(text)
    counts = _ARM_COUNT.findall(text)
    if any(x in text.lower() for x in _NOT_ARMS) or not 2 <= len(counts) <= 4:
        return ""
    total = sum(int(_digits(x)) for x in counts)
    return str(total) if total else ""


def about_one_arm(intervention: str, comparator: str, evidence: str) -> bool:
    """Whether a row compares arms, so that the whole study's number isn't its own."""
    own, other, said = (tidy(x).lower() for x in (intervention, comparator, evidence))
    return bool(other) and ((bool(own) and own != other) or any(x in said for x in _VERSUS))


def sample_size(raw: str, context: str = "", whole: bool = True) -> str:
    """The row's own number; if it may be the ``whole`` study's, the sum of its arms or the context's first total."""
    if found := bare_count(raw) or (arms_total(raw) if whole else ""):
        return found
    text = tidy(context) if whole else ""
    for pattern in _STATED_COUNT:
        for m in pattern.finditer(text):
            around = tidy(window(text, m, 30, 40)).lower()
            if not any(x in around for x in _NOT_TOTAL) and not re.search(r"\d\s*/\s*\d", around):
                return _digits(m[1])
    return ""


# Times.


def _numbered(text: str) -> str:
    """Number words up to twelve as digits."""
    for n, word in enumerate(_NUMBER_WORDS, 1):
        text = re.sub(rf"\b{word}\b", str(n), text, flags=re.IGNORECASE)
    return text


def _label(amount: str, unit: str) -> str:
    amount = tidy(amount).replace(" to ", "-")
    unit = unit.lower().rstrip("s")
    return f"{amount} {unit}" if re.fullmatch(r"1(?:\.0+)?", amount) else f"{amount} {unit}s"


def duration(text: str) -> str:
    """The first duration as ``6 weeks`` or ``8-12 weeks``."""
    m = _DURATION.search(_numbered(tidy(text)))
    return _label(m[1], m[2]) if m else ""


def durations(text: str) -> list[str]:
    return distinct((_label(m[1], m[2]) for m in _DURATION.finditer(_numbered(tidy(text)))), tidy)


def days(label: str) -> float:
    """Length of a duration's label, of a range its end; -1 for none."""
    amount, _, unit = label.rpartition(" ")
    try:
        return float(amount.split("-")[-1].strip()) * _DAYS[unit.lower().rstrip("s")]
    except (KeyError, ValueError):
        return -1.0


def latest(labels: list[str]) -> str:
    """The longest duration, the first of equal ones."""
    return max(labels, key=days)


def follow_up_text(*texts: str) -> str:
    """Up to two durations that a text names as follow-up, as they are written."""
    text = " ".join(tidy(x) for x in texts if x).strip()
    found: dict[str, str] = {}
    for pattern in _FOLLOW_UPS:
        for m in pattern.finditer(text):
            value = tidy(m[1]).strip(" ,;.")
            if value:
                found.setdefault(value.lower(), value)
            if len(found) == 2:
                return "; ".join(found.values())
    return "; ".join(found.values())


def follow_ups(text: str) -> list[str]:
    return [x for x in map(duration, follow_up_text(text).split(";")) if x]


def schedule(text: str) -> bool:
    """Whether a text lists assessments rather than a time."""
    low = tidy(text).lower()
    return len(low) > 60 or any(x in low for x in _book().schedule) or (len(_DURATION.findall(low)) >= 2 and bool(re.search("[,;]", low)))


def follow_up(raw: str, context: str = "") -> str:
    """The latest of several durations, or the one, unless it is part of a schedule; else the latest follow-up that raw text or context name."""
    found = durations(raw)
    if len(found) > 1:
        return latest(found)
    one = duration(raw)
    if one and not schedule(raw):
        return one
    told = follow_ups(raw) or follow_ups(context)
    return latest(told) if told else ""


# Populations.


def population_cue(text: str) -> bool:
    """Whether a text speaks of any trait of a population."""
    low, signal = tidy(text).lower(), _book().signal
    names = ("AGE", "GENDER", "ETHNICITY", "OCCUPATION", "SOCIAL_STATUS", "TREATMENT_HISTORY")
    if any(signal[x].search(low) for x in names):
        return True
    return bool(signal["POPULATION_ENTITY_NOUN"].search(low)) and any(signal[x].search(low) for x in ("SETTING", "RELATION", "CLINICAL_POPULATION_CONTEXT"))


def severity_cue(text: str) -> bool:
    text = tidy(text)
    return any(p.search(text) for p in (_SEVERITY_WORDS, _book().scale, _book().signal["RISK"]))


def uncounted(text: str) -> str:
    """Without the number of people that a phrase begins with."""
    return tidy(_book().counts.rewrite(tidy(text)))


def cleaned_phrase(fragment: str) -> str:
    """What a phrase tells of a population, without counts, scores, risks, diagnoses and the study's conduct."""
    text = whole = uncounted(fragment)
    for start, heading in _book().starts:
        m = start.search(text)
        if m and m.start() > 18 and heading.search(text[: m.start()]):
            text = text[m.start() :]
    text = tidy(_book().cleaning.rewrite(text))
    return whole if _PLAIN_PEOPLE.fullmatch(text) and _DIAGNOSED.search(whole) else text


def of_purpose(text: str) -> bool:
    return _book().purpose.any(tidy(text).lower())


def useful(text: str) -> bool:
    """Whether a cleaned phrase describes a population and nothing else."""
    text = tidy(text)
    low, signal = text.lower(), _book().signal
    if not text or of_purpose(text):
        return False
    if _GROUP_ALONE.fullmatch(low) or (_GROUP.fullmatch(text) and not _ILLNESS.search(low)) or _SURVIVORS.fullmatch(text):
        return True
    people = bool(signal["POPULATION_ENTITY_NOUN"].search(text))
    if not population_cue(text) and not (people and not _CONDUCT.search(text) and _CONTEXTUAL.search(text)):
        return False
    if any(p.search(text) for p in (signal["SAMPLE_COUNT"], _book().scale, signal["RISK"], signal["RESULT_VERB"], _GIVEN_BY, _VETERANS_AFFAIRS)):
        return False
    role = signal["PROVIDER_ROLE"]
    if role.fullmatch(text) or (role.search(text) and signal["PROVIDER_CONTEXT"].search(text)):
        return False
    state = signal["TREATMENT_HISTORY"]
    if (state.fullmatch(text) and low in _STATES_TOO_VAGUE) or (state.search(text) and not people and low not in _STATES_ALONE):
        return False
    return low not in _NEVER


def snippets(text: str) -> list[str]:
    """Parts of a sentence that tell of a population, unless of those who treat it or of a waiting list."""
    text, signal = tidy(text), _book().signal

    def own(text: str, m: re.Match) -> bool:
        hit, around = tidy(m[0]), window(text, m, 60, 60)
        return not (
            (signal["OCCUPATION"].search(hit) and _book().by_provider.search(around))
            or (signal["TREATMENT_HISTORY"].search(hit) and _WAITING.search(around))
            or signal["PROVIDER_ROLE"].fullmatch(hit)
        )

    return distinct((m[0] for m, _ in _book().snippets.hits(text, own)), tidy)


def _within(part: str, whole: str) -> bool:
    return bool(re.search(rf"(?<![A-Za-z0-9]){re.escape(part.lower())}(?![A-Za-z0-9])", whole.lower()))


def absorb(kept: list[str], phrase: str) -> None:
    """Adds a phrase, unless one that is kept holds it; it takes the place of the first that it holds."""
    phrase = tidy(phrase)
    for i, other in enumerate(kept if phrase else ()):
        if _within(phrase, other):
            return
        if _within(other, phrase):
            kept[i] = phrase
            return
    if phrase:
        kept.append(phrase)


def points(text: str) -> int:
    """How much a phrase tells of a population."""
    text, signal = tidy(text), _book().signal
    if not text:
        return -999
    out = 5 if _AGES.search(text) else 2 if _AGE_WORDS.search(text) else 0
    out += sum(n for name, n in _POINTS if signal[name].search(text))
    return out + sum(n for pattern, n in _OTHER_POINTS if pattern.search(text))


def needs_support(text: str) -> bool:
    """Whether a phrase says so little that the context should add to it."""
    text = tidy(text)
    return not text or bool(_NEEDS_SUPPORT.fullmatch(text)) or (len(text) <= 18 and bool(_SHORT_SUPPORT.search(text)))


def population(raw: str, context: str = "") -> str:
    """Up to three phrases on the population: the raw text's, with the context's where those say too little."""
    kept: list[str] = []
    anchor = ""
    for fragment in fragments(raw):
        for candidate in ([f"{anchor} {fragment}"] if anchor and _GOES_ON.match(fragment) else []) + [fragment]:
            whole = cleaned_phrase(candidate)
            if useful(whole) and not of_purpose(candidate):
                absorb(kept, _clip(whole, PHRASE))
                continue
            for hit in map(cleaned_phrase, snippets(candidate)):
                if useful(hit):
                    absorb(kept, _clip(hit, PHRASE))
        if not _NO_ANCHOR.match(fragment):
            anchor = fragment
    if not kept or (len(kept) == 1 and needs_support(kept[0])):
        _support(kept, context, bool(tidy(raw)))
    kept = distinct(kept, tidy)
    best = sorted(range(len(kept)), key=lambda i: (-points(kept[i]), i))[:PHRASES]
    return " || ".join(kept[i] for i in sorted(best))


def _support(kept: list[str], context: str, told: bool) -> None:
    for fragment in fragments(context):
        if of_purpose(fragment) or _NO_CONTEXT.search(fragment):
            continue
        for hit in snippets(fragment):
            phrase = _clip(cleaned_phrase(hit) or hit, PHRASE)
            if useful(phrase) and (told or not _GENERIC.fullmatch(phrase)):
                absorb(kept, phrase)
                if len(kept) >= PHRASES:
                    return


def severity(raw: str, population_raw: str = "", context: str = "") -> str:
    """The first three phrases of severity, the raw text's before the population's and the context's."""
    found = [x for text in (raw, population_raw, context) for m, _ in _book().severity.hits(tidy(text)) if (x := uncounted(m[0]))]
    return " || ".join(distinct(found[:3], tidy))


def treatment_history(raw: str, population_raw: str = "", context: str = "") -> str:
    """The first three states of treatment, outside sentences of purpose."""
    state = _book().signal["TREATMENT_HISTORY"]
    found = [m[0] for text in (raw, population_raw, context) for x in fragments(text) if not of_purpose(x) for m in state.finditer(x)]
    return " || ".join(distinct([x for x in map(tidy, found) if x][:3], tidy))


# Results.


def opened(text: str) -> str:
    return tidy(_book().opening.rewrite(tidy(text)))


def evidence_points(text: str) -> int:
    """How much a sentence tells of results."""
    text, signal = tidy(text), _book().signal
    if not text:
        return -999
    low, stated = text.lower(), bool(signal["RESULT_STAT"].search(text))
    out = 4 if stated else -2 * sum(bool(signal[x].search(text)) for x in ("SAMPLE_COUNT", "RISK"))
    out += 3 * any(x in low for x in _RESULT_WORDS) + any(x in low for x in _COMPARED)
    return out - 8 * _book().evidence_purpose.any(low) - (len(text) > EVIDENCE)


def _best(sentences: list[str]) -> tuple[int, str]:
    told = [(evidence_points(x), x) for x in map(opened, sentences) if x]
    return max(told, key=lambda x: x[0], default=(-999, ""))


def evidence(raw: str, context: str = "") -> str:
    """The raw text's best sentence of results, else the context's, where it tells enough."""
    for sentences in (fragments(raw), _EVIDENCE_END.split(tidy(context)) if tidy(context) else []):
        score, best = _best(sentences)
        if score >= ENOUGH:
            return _clip(best, EVIDENCE)
    return ""


def outcome(raw: str, told: str = "") -> str:
    """Direction of an outcome: what was said, else what its sentence says; no difference counts before an effect."""
    said, text = tidy(raw).lower(), " ".join(x for x in (tidy(raw).lower(), tidy(told).lower()) if x)
    if label := next((k for k, v in _SAID.items() if said in v), ""):
        return label
    if not text or any(x in text for x in _MIXED):
        return UNDECIDED
    if said in ("mixed", "unknown") and not tidy(told):
        return UNDECIDED
    book = _book()
    if any(x in text for x in book.outcome["neutral"]):
        return "Neutral"
    good, bad = (any(x in text for x in book.outcome[k]) or book.outcome_context[k].any(text) for k in ("positive", "negative"))
    return UNDECIDED if good == bad else "Positive" if good else "Negative"


# Indications.


def of_depression(text: str) -> bool:
    low = tidy(text).lower()
    return any(x in low for x in _book().depression)


def of_people(text: str) -> bool:
    return bool(_PEOPLE_HINT.search(text))


def split_hint(text: str) -> tuple[str, str]:
    """An indication, and the people that it is said to be in."""
    text = tidy(text)
    for pattern in _HINTS:
        if (m := pattern.search(text)) and of_people(tidy(m[1])):
            return tidy(text[: m.start()]), tidy(m[1])
    return text, ""


def condition(text: str) -> str:
    """The first condition that a text names; else its own words, up to 60 characters, unless they are of people."""
    low = tidy(text).lower()
    if label := _book().conditions.first(low):
        return label
    own = "" if of_people(low) else tidy(_NO_CONDITION.sub("", low))
    return own if len(own) <= 60 else ""


def comorbidities(text: str) -> list[str]:
    return _book().comorbidities.which(tidy(text).lower())


def indication(raw: str, context: str = "") -> str:
    """All conditions of a text on depression, its forms first and without those that a narrower one says; of another text the one condition."""
    text, around = tidy(raw), tidy(context)
    if not text:
        return ""
    core = split_hint(text)[0] or text
    if not of_depression(core):
        return condition(core) or condition(around) or ("" if of_people(core) else core)
    found = [condition(m[0]) for m, _ in _book().forms.hits(core)]
    found += [condition(m[g]) for p in _COORDINATED for m in p.finditer(core) for g in (1, 2)]
    found = distinct([*found, *comorbidities(" ".join(x for x in (core, around) if x))], tidy)
    if len(found) > 1:
        found = _narrowed(found)
    return " || ".join(found) or "depression"


def _narrowed(found: list[str]) -> list[str]:
    def depressive(x: str) -> bool:
        return "depress" in x.lower() or x.lower() == "dysthymic disorder"

    if any(x.lower() in _SUBTYPES for x in found):
        found = [x for x in found if x.lower() in _SUBTYPES or not depressive(x)]
    for broad, stem in (("depression", "depress"), ("depressive disorder", "depressive")):
        if any(x.lower() != broad and stem in x.lower() for x in found):
            found = [x for x in found if x.lower() != broad]
    return sorted(found, key=lambda x: not depressive(x))


def intervention_type(kind: str, name: str) -> str:
    """A combination, unless with a control; else what the type says, else what the name says, else ``Other``."""
    said, low = tidy(kind).lower(), f"{tidy(name).lower()}"
    if re.search(arms.COMBINED, low) and not re.search(arms.NOT_COMBINED, low):
        return "Combination Product"
    for text, table in ((said, arms.TYPES), (low, arms.TYPES_BY_NAME)):
        for pattern, label in table:
            if re.search(pattern, text):
                return label
    return "Other"


def target(raw: str, intervention: str, indication_: str) -> str:
    """A target of a few words that is neither the intervention nor the indication, nor words of the study without a mechanism."""
    text = tidy(raw)
    low = text.lower()
    if low in (tidy(intervention).lower(), tidy(indication_).lower()):
        return ""
    if any(x in low for x in _NO_TARGET) and not any(x in low for x in _TARGETS):
        return ""
    return text if len(text.split()) <= 8 and len(text) <= 80 else ""


INPUTS = (
    "source_index", "indication", "population_raw", "severity", "treatment_history", "target", "intervention", "intervention_type", "comparator", "outcome_direction",
    "sample_size", "follow_up_time", "evidence_snippet",
)
CONTEXTS = ("context", "population_context", "evidence_context")


def normalized(*values: str) -> dict[str, str]:
    """All fields of a row, from INPUTS and CONTEXTS."""
    raw = dict(zip((*INPUTS, *CONTEXTS), map(tidy, values)))
    context = raw["context"]
    people, results = raw["population_context"] or context, raw["evidence_context"] or context
    kind = intervention_type(raw["intervention_type"], raw["intervention"] or raw["comparator"])
    own, other = (arms.label(raw[x], kind) for x in ("intervention", "comparator"))
    told = evidence(raw["evidence_snippet"], results)
    what = indication(raw["indication"], " ; ".join(x for x in (raw["population_raw"], context) if x))
    return {
        "source_index": source_index(raw["source_index"]),
        "indication": what,
        "population_raw": population(raw["population_raw"], people),
        "severity": severity(raw["severity"], raw["population_raw"], people),
        "treatment_history": treatment_history(raw["treatment_history"], raw["population_raw"], people),
        "target": target(raw["target"], own, what),
        "intervention": own,
        "intervention_type": kind,
        "comparator": other,
        "outcome_direction": outcome(raw["outcome_direction"], told),
        "sample_size": sample_size(raw["sample_size"], context, not about_one_arm(raw["intervention"], raw["comparator"], raw["evidence_snippet"])),
        "follow_up_time": follow_up(raw["follow_up_time"], context or told),
        "evidence_snippet": told,
    }


ROW = structure(INPUTS)


def fields(raw: dict[str, Column], contexts: dict[str, Column]) -> Column:
    """``normalized`` over columns, as one struct."""
    return column(normalized, ROW)(*(raw[x] for x in INPUTS), *(contexts[x] for x in CONTEXTS))
