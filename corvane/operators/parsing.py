"""Parsed records: a block of an exported citation, or a record of a cleaned corpus, as a struct.

Both readers first say what every line or paragraph is, then take what each kind
gives. They work on one record's text in Arrow batches; a record is small. Null
and blank texts give a struct of empty fields.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import evidence
from corvane.functions.phrases import column, compiled, rows, squeeze, structure
from corvane.functions.text import clean

# Lines and paragraphs of an exported citation.
_DOI = compiled(r"\bdoi:\s*(10\.\d{4,}/\S+)")
_BARE_DOI = re.compile(r"\b(10\.\d{4,}/\S+)")
_LINES = {
    "pmcid": compiled(r"^PMCID:\s*"),
    "doi": compiled(r"^DOI:\s*(.+)"),
    "pmid": compiled(r"^PMID:\s*(\d+)"),
    "doi_rest": compiled(r"^(10\.\d{4,}/\S.*)"),
}
_DATE = compiled(r"^(?:Epub\s+)?(?:19|20)\d{2}\s+[A-Z][a-z]{2}\s+\d{1,2}\.?$")
_AUTHOR = re.compile(r"^[A-Z][\w'.-]+(?:\s+[A-Z][\w'.-]+)*\(\d+\)")
_NAME = re.compile(r"\b[A-Z][a-zA-Z'.-]+(?:-[A-Z][a-zA-Z'.-]+)?\s+(?:[A-Z]{1,4}(?:\s+Jr)?|[A-Z][a-z]+(?:\s+[A-Z]{1,3})?)\b")
_NOTICE = (
    compiled(r"^\[Article in [^\]]+\]"),
    compiled(r"^(?:©|\(C\)|漏)"),
    compiled(r"^(?:crown\s+)?copyright\b"),
    compiled(r"^(?:comment|erratum|update|retraction|republished|expression of concern|corrected and republished)\s+(?:in|for|from|of)\b"),
)
_STATEMENTS = (
    compiled(r"\bSTUDY FUNDING/COMPETING INTERESTS:.*?(?=\bTRIALS?\s+REGISTRATION|\bTRIAL REGISTRATION DATE\b|$)"),
    compiled(r"\b(?:Conflict of interest statement:|Declaration of competing interests?:)\s*.*$"),
    compiled(
        r"\b(?:None of the authors have any conflicts of interest to declare\.|There were no competing interests\.|The authors declare no competing (?:financial )?interests\.)"
    ),
)
_UNITS = compiled(r"(\d)(mg|g|ml|kg|mcg|ug)\b")
_SIGNS = {"–": "-", "—": "-", "−": "-", "≤": "<=", "≥": ">=", "±": "+-", "‘": "'", "’": "'", "“": '"', "”": '"', " ": " ", " ": " ", "×": "x"}
# Labels of a cleaned record, longest first, and the order in which a model is shown them.
HEADERS = (
    "MAIN OUTCOMES AND MEASURES", "MAIN OUTCOME MEASURES", "TRIAL REGISTRATION", "INTERVENTIONS", "PARTICIPANTS", "CONCLUSIONS", "LIMITATIONS", "BACKGROUND", "OBJECTIVES",
    "OBJECTIVE", "PATIENTS", "ABSTRACT", "METHODS", "RESULTS", "SETTING", "FUNDING", "SUMMARY", "DESIGN",
)
SHOWN = (
    "OBJECTIVE", "OBJECTIVES", "BACKGROUND", "PATIENTS", "PARTICIPANTS", "METHODS", "INTERVENTIONS", "MAIN OUTCOMES AND MEASURES", "MAIN OUTCOME MEASURES", "RESULTS",
    "CONCLUSIONS", "TRIAL REGISTRATION",
)
#: Sections of the contexts, in order; the registration is shown, but is no context.
CONTEXT = (*SHOWN[:-1], "SUMMARY")
POPULATION = ("PATIENTS", "PARTICIPANTS", "METHODS", "SUMMARY", "BACKGROUND")
EVIDENCE = ("RESULTS", "CONCLUSIONS", "MAIN OUTCOMES AND MEASURES", "MAIN OUTCOME MEASURES", "SUMMARY")
RESCUE = ("PATIENTS", "PARTICIPANTS", "METHODS", "DESIGN", "SETTING", "BACKGROUND", "OBJECTIVE", "OBJECTIVES", "SUMMARY", "RESULTS")
_LABEL = compiled(r"\b(" + "|".join(map(re.escape, HEADERS)) + r")\s*:\s*")
_SHORT_DATE = re.compile(r"^(?:(?:Epub\s+)?\d{4}\s+)?[A-Za-z]{3}\s+\d{1,2}\.?$")
_META = compiled(r"^PMID:|\sDOI:|\sYEAR:|^\[(?=.{0,6}\])")
_IDS = {
    "pmid": compiled(r"\bPMID:\s*([0-9]+)\b"),
    "doi": compiled(r"\bDOI:\s*([^\s]+)"),
    "year": compiled(r"\bYear:\s*(\d{4})\b"),
}
_NCT = compiled(r"\b(NCT\d{8})\b")
_YEAR = re.compile(r"\b(?:19|20)\d{2}\b")
_INTERESTS = "conflict of interest statement"


@lru_cache(maxsize=1)
def _notices() -> tuple[str, ...]:
    return tuple(r[0] for r in rows("notice_openings"))


def doi(text: str) -> str:
    """A DOI after its label, else any, without punctuation at its end."""
    m = _DOI.search(text) or _BARE_DOI.search(text)
    return m[1].strip().rstrip(".,;)]") if m else ""


def citation(text: str) -> str:
    """A journal line without its DOI."""
    return re.sub(r"\s*\.\s*\.\s*", ". ", re.sub(r"\s+", " ", _DOI.sub("", text))).strip(" .")


def authors(lines: list[str]) -> bool:
    """Whether a paragraph lists names."""
    text = " ".join(lines)
    if "no authors listed" in text.lower():
        return True
    if not text or len(text) > 500 or ":" in text:
        return False
    commas = text.count(",")
    return (commas >= 1 and bool(_AUTHOR.match(text))) or (commas >= 2 and len(_NAME.findall(text)) >= 3)


def notice(line: str) -> bool:
    """Whether a line opens a notice: copyright, corrections, comments, interests, addresses."""
    text = squeeze(line)
    return text.casefold().startswith(_notices()) or any(p.match(text) for p in _NOTICE)


def without_statements(text: str) -> str:
    for pattern in _STATEMENTS:
        text = pattern.sub("", text)
    return squeeze(text)


def paragraphs(lines: list[str]) -> list[list[str]]:
    """Runs of lines that aren't blank, each line without white space around it."""
    out: list[list[str]] = [[]]
    for line in map(str.strip, lines):
        if line:
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return [x for x in out if x]


def clean_units(text: str) -> str:
    """ASCII signs, a space between number and unit, soft line ends joined."""
    for sign, plain in _SIGNS.items():
        text = text.replace(sign, plain)
    text = re.sub(r"(?<![.!?:;])\n(?=[a-z(])", " ", _UNITS.sub(r"\1 \2", text))
    return re.sub(r"[ \t]+", " ", text).strip()


EXPORT = T.StructType([T.StructField("index", T.IntegerType()), *(T.StructField(n, T.StringType()) for n in ("pmid", "doi", "journal_line", "title", "abstract"))])


def export_block(block: str) -> dict | None:
    """A numbered block: journal line, title, authors, body, identifiers. None for a block without a number."""
    lines = block.splitlines()
    head = re.match(r"^(\d+)\.\s+(.*)", lines[0]) if lines else None
    if head is None:
        return None
    end = next((i for i, x in enumerate(lines) if i and not x.strip()), len(lines))
    header = squeeze(" ".join([head[2], *lines[1:end]]))
    out = {"index": int(head[1]), "pmid": "", "doi": doi(header), "journal_line": citation(header), "title": "", "abstract": ""}
    groups = paragraphs(lines[end + 1 :])
    at = next((i for i, x in enumerate(groups) if not notice(x[0]) and not _DATE.match(" ".join(x))), None)
    if at is not None:
        out["title"] = " ".join(groups[at])
        at += 1
        while at < len(groups) and authors(groups[at]):
            at += 1
        out["abstract"] = "\n\n".join(x for x in (_body(g, out) for g in groups[at:] if not authors(g)) if x)
    if not out["pmid"]:
        out["pmid"] = next((m[1] for x in lines if (m := _LINES["pmid"].match(x.strip()))), "")
    if groups and not out["doi"]:
        out["doi"] = doi(block)
    return out


def _body(lines: list[str], out: dict) -> str:
    """A paragraph's own text up to a notice; the identifiers among its lines go to ``out``."""
    kept: list[str] = []
    for line in lines:
        if notice(line):
            break
        kind, m = next(((k, m) for k, p in _LINES.items() if (m := p.match(line)) and not (k == "doi_rest" and kept)), ("text", None))
        if kind == "text":
            kept.append(line)
        elif kind == "pmid":
            out["pmid"] = m[1]
        elif kind != "pmcid":
            out["doi"] = out["doi"] or m[1].strip().rstrip(".,;)]")
    return without_statements(" ".join(kept))


RECORD = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in ("journal_line", "pmid", "nct_id", "doi", "year", "date_line", "title")),
        T.StructField("sections", T.MapType(T.StringType(), T.StringType())),
    ]
)


def header(line: str) -> bool:
    return ":" in line and line.split(":", 1)[0].strip().upper() in HEADERS


def meta(line: str) -> bool:
    """Whether a line has identifiers, a date, or nothing."""
    return not line.strip() or bool(_META.search(line.strip())) or bool(_SHORT_DATE.match(line.strip()))


def section_name(label: str) -> str:
    name = label.strip().upper()
    begins = {"CONCLUSIONS": "CONCLUSIONS", "OBJECTIVE": "OBJECTIVE", "MAIN OUTCOME": "MAIN OUTCOMES AND MEASURES"}
    return next((v for k, v in begins.items() if name.startswith(k)), name)


def chunks(line: str) -> list[tuple[str, str]]:
    """(section, content) of each label in a line."""
    found = list(_LABEL.finditer(line))
    ends = [m.start() for m in found[1:]] + [len(line)]
    return [(section_name(m[1]), line[m.end() : e].strip()) for m, e in zip(found, ends)]


def title(lines: list[str]) -> str:
    """A title from its lines; empty if they are something else."""
    text = re.sub(r"\s+", " ", " ".join(lines)).strip(" .;-")
    low = text.lower()
    if "doi:" in low or "pmid:" in low or header(text + ":") or re.match(r"^\d{4}\s+[A-Za-z]{3}\s+\d{1,2}$", text):
        return ""
    return text if 15 <= len(text) <= 240 and len(text.split()) <= 36 and text.count(". ") <= 1 else ""


def record(text: str) -> dict:
    """A record of a cleaned corpus: journal line, identifiers, title, and its labelled sections or a summary."""
    lines = [x.strip() for x in text.replace("\r\n", "\n").split("\n")]
    out: dict = dict.fromkeys((f.name for f in RECORD.fields[:-1]), "") | {"sections": {}}
    first = next((i for i, x in enumerate(lines) if x), None)
    if first is None:
        return out
    out["journal_line"] = re.sub(r"^\[\d+\]\s*", "", lines[first]).strip()
    at = first + 1
    while at < len(lines):
        line = lines[at]
        ids = any(x in line.upper() for x in ("PMID:", "DOI:", "YEAR:"))
        if line:
            if ids:
                out |= {k: m[1].rstrip(".;,") if k == "doi" else m[1] for k, p in _IDS.items() if (m := p.search(line))}
            if m := _NCT.search(line):
                out["nct_id"] = out["nct_id"] or m[1].upper()
            if not ids and not _SHORT_DATE.match(line):
                break
            if not ids:
                out["date_line"] = out["date_line"] or line
        at += 1
    if not out["nct_id"] and (m := _NCT.search(text)):
        out["nct_id"] = m[1].upper()
    out["year"] = out["year"] or next((m[0] for x in lines[first : first + 6] if (m := _YEAR.search(x))), "")
    out["title"], at = _title(lines, at)
    out["sections"] = _sections(lines[at:])
    return out


def _title(lines: list[str], at: int) -> tuple[str, int]:
    """The title that begins at a line, three lines at most, and where it ends; what is none is left to the sections."""
    begin, held = at, []
    while at < len(lines) and len(held) < 3:
        line = lines[at]
        if line and (header(line) or meta(line) or line.lower().startswith(_INTERESTS)):
            break
        at += 1
        if line:
            held.append(line)
        elif held:
            break
    found = title(held)
    return (found, at) if found else ("", begin)


def _sections(lines: list[str]) -> dict[str, str]:
    parts: dict[str, list[str]] = {}
    now, free = "", []
    for line in lines:
        if line.lower().startswith(_INTERESTS):
            break
        if meta(line):
            continue
        labelled = chunks(line)
        for name, content in labelled:
            now = name
            if content:
                parts.setdefault(name, []).append(content)
        if not labelled:
            (parts.setdefault(now, []) if now else free).append(line)
    out = {k: " ".join(v).strip() for k, v in parts.items()}
    if free:
        out["SUMMARY"] = " ".join(free).strip()  # unlabelled lines take the place of a labelled summary
    elif not out and not now:
        out["SUMMARY"] = ""
    return out


def parse_export(blocks: DataFrame, block: str = "record") -> DataFrame:
    """``blocks`` with the fields of each as columns; blocks without a number are dropped."""
    parsed = blocks.withColumn("_parsed", column(export_block, EXPORT)(F.col(block))).where(F.col("_parsed.index").isNotNull())
    return parsed.select(*blocks.columns, *(F.col(f"_parsed.{f.name}").alias(f.name) for f in EXPORT))


def parse_records(records: DataFrame, text: str = "record") -> DataFrame:
    """``records`` with the fields of each as columns."""
    parsed = records.withColumn("_parsed", column(record, RECORD)(F.col(text)))
    return parsed.select(*records.columns, *(F.col(f"_parsed.{f.name}").alias(f.name) for f in RECORD))


def _section(sections: Column, name: str) -> Column:
    return clean(F.try_element_at(sections, F.lit(name)))


def _joined(*parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), " ")


def whole_context(title: Column, sections: Column) -> Column:
    return _joined(clean(title), *(_section(sections, n) for n in CONTEXT))


def population_context(title: Column, sections: Column) -> Column:
    return _joined(clean(title), *(_section(sections, n) for n in POPULATION))


def evidence_context(title: Column, sections: Column) -> Column:
    """The sections of results; the whole context where there are none."""
    own = _joined(*(_section(sections, n) for n in EVIDENCE))
    return F.coalesce(F.nullif(own, F.lit("")), whole_context(title, sections))


def _told(sections: Column, name: str) -> Column:
    """A section; results only where they speak of the population or of severity."""
    said = _section(sections, name)
    if name != "RESULTS":
        return said
    cue = column(lambda x: evidence.population_cue(x) or evidence.severity_cue(x), "boolean")
    return F.when(cue(said), said).otherwise("")


def rescue_context(title: Column, sections: Column) -> Column:
    return _joined(clean(title), *(_told(sections, n) for n in RESCUE))


def labelled(pairs: list[tuple[str, Column]]) -> Column:
    """``LABEL: text`` lines of what isn't empty."""
    return F.array_join(F.filter(F.array(*(F.when(v != "", F.concat(F.lit(f"{k}: "), v)).otherwise("") for k, v in pairs)), lambda x: x != ""), "\n")


def prompt_text(nct_id: Column, sections: Column) -> Column:
    """What a model is shown of a record: its registration number and its sections in a fixed order."""
    return labelled([("NCT ID", F.coalesce(nct_id, F.lit(""))), *((n, F.coalesce(F.try_element_at(sections, F.lit(n)), F.lit(""))) for n in (*SHOWN, "SUMMARY"))])


def rescue_prompt(title: Column, sections: Column) -> Column:
    return labelled([("TITLE", clean(title)), *((n, _told(sections, n)) for n in RESCUE)])


def corpus_size(texts: DataFrame, text: str, batch: int, prompt: str = "") -> DataFrame:
    """One row: records, batches, and the tokens that they and a prompt for each batch are estimated to have."""
    from corvane.functions.text import token_estimate

    one = texts.agg(F.count("*").alias("records"), F.coalesce(F.sum(token_estimate(F.col(text))), F.lit(0)).alias("own"))
    batches = F.ceil(F.col("records") / batch)
    return one.select("records", batches.alias("batches"), (F.col("own") + batches * max(1, -(-len(prompt) // 4))).alias("tokens"))


ROW = structure((*evidence.INPUTS, "population_status", "phase"))


def output_row(*values: str) -> dict | None:
    """A row of the table of pairs from a model's answer and a record's contexts; None without arm and evidence, or without a record's number.

    The fields are those of ``evidence.normalized``, with the model's words where the rules find nothing in them.
    """
    raw = dict(zip((*evidence.INPUTS, *evidence.CONTEXTS), values))
    found = evidence.normalized(*values)
    if not found["source_index"].isdigit():
        return None
    context = squeeze(raw["context"])

    def filled(name: str, limit: int) -> str:
        text = squeeze(found[name]) or squeeze(raw[name])
        return text if len(text) <= limit else text[: limit - 3].rstrip() + "..."

    row = {n: filled(n, limit) for n, limit in (("intervention", 240), ("comparator", 240), ("evidence_snippet", 420), ("target", 200))}
    if not (row["intervention"] or row["comparator"] or row["evidence_snippet"]):
        return None
    people = _phrases(found["population_raw"] or raw["population_raw"])
    told = {"population": bool(squeeze(raw["population_raw"])), "severity": bool(squeeze(raw["severity"]))}
    return {
        **{n: squeeze(found[n]) for n in evidence.INPUTS},
        **row,
        "population_raw": people,
        "outcome_direction": found["outcome_direction"] or evidence.UNDECIDED,
        "follow_up_time": squeeze(found["follow_up_time"]) or evidence.follow_up_text(context),
        "population_status": status(told, people, found["severity"]),
        "phase": evidence.phase(context),
    }


def _phrases(text: str) -> str:
    """Up to three different phrases, 220 characters at most."""
    from corvane.functions.phrases import clip, distinct

    return clip(" || ".join(distinct(text.split("||"))[:3]), 220)


def status(told: dict[str, bool], population: str, severity: str) -> str:
    """Where a row's population and severity come from: the model, or the rules for that row."""
    if told["population"]:
        return "main_pass_plus_row_local_severity" if severity and not told["severity"] else "main_pass"
    if population:
        return "row_local_population_and_severity" if severity else "row_local_population"
    return "row_local_severity_only" if severity else ""


def output_rows(answers: DataFrame, contexts: DataFrame, key: str = "record_id") -> DataFrame:
    """Rows of the table of pairs: a model's answers joined with their record's contexts; answers without a record are dropped."""
    own = contexts.select(F.col(key).alias("_key"), *evidence.CONTEXTS)
    joined = answers.join(own, F.col(key) == F.col("_key")).drop("_key")
    found = column(output_row, ROW)(*(F.col(n).cast("string") for n in (*evidence.INPUTS, *evidence.CONTEXTS)))
    rows_ = joined.select(F.col(key), found.alias("_row")).where(F.col("_row").isNotNull())
    return rows_.select(key, "_row.*")
