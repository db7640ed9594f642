"""The search that is made only where a match may begin, against the patterns as they stand."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from corvane.functions import extract, rules, tables
from corvane.plans.text_queries import extract_row

PIECES = (
    "Sertraline;ESKETAMINE;ketamine;xketamine;rTMS;TMS2;electro convulsive therapy;electroconvulsive  therapy;deep\nbrain stimulation;_placebo;éplacebo;placebo;sham;TAU;"
    "tofacitinib;lorazepam;pine;zolpine;aaaaapine;AMOXICILLIN;omeprazoles;done;methadone;efficacy;non-effective;response rate;treatment effect;double-blind;"
    "HPA  axis;EEG;proteomics;serotonin syndrome;significantly improved;no significant difference;not significantly;non-significant;did not differ;NONE;well-tolerated;"
    "adverse event;toxicity;toxicities;QT prolongation;discontinued due to;side effects;Nausea;dropout;drop-out;self-harm;insomnia;5 mg;5.5mg/day;1.2.3 mg;007 IU;12. g;5 mgs;3mg4ml;"
    "12-week follow-up;6 months trial;follow up of 3 years;1 year study;12 day;over a 2 week period;assessed over 5 weeks;total of 60 participants;randomized 88;n = 25;N=123456;mean = 30;A total of 40 patients;Xrandomized 77;enrolle 12;recruited 31;"
    "OR = 1.5;odds ratio (OR) = 2;FOR = 3;hazard ratio, -1;RR: 2;mdd;MDDs;post-traumatic stress;MS;trial;cancer;.;.;.; ;, ;\n;-;ſham;K;İ;é"
).split(";")


def _texts() -> list[str]:
    dice = random.Random(3)
    return ["", "."] + [dice.choice(["", " "]).join(dice.choices(PIECES, k=dice.randint(1, 14))) for _ in range(600)]


def test_same_matches(spark):
    texts = spark.createDataFrame([(x,) for x in _texts()], "t string").repartition(4).select("t", rules.beginnings(F.col("t")).alias("words")).cache()
    t, words = F.col("t"), F.col("words")
    plain, fast = [], []
    for p in (tables.DRUGS, tables.EVENTS, tables.EFFICACY, tables.MECHANISM, tables.POSITIVE, tables.NEGATIVE, tables.HARMFUL, tables.HARMLESS):
        plain += [rules.found(t, p), rules.found(t, p)]
        fast += [rules.found(t, p, words=words), rules.found(t, rules.quick(p))]
    for p, q in [
        (tables.DOSE, extract._DOSE),
        (tables.DRUG_ENDINGS, extract._ENDINGS),
        (tables.RATIO, rules.quick(tables.RATIO)),
        (tables.EVENT_SENTENCE, rules.at(extract._SENTENCE, tables.EVENT_SENTENCE)),
        *zip(tables.SAMPLES, extract._SAMPLES),
        *zip(tables.FOLLOW_UPS, extract._FOLLOW_UPS),
    ]:
        plain.append(rules.found(t, p))
        fast.append(rules.found(t, q))
    plain.append(F.array(rules.first_match(t, tables.INDICATIONS, None)))
    fast.append(F.array(rules.first_match(t, tables.INDICATIONS, None, F.lower(t))))
    got = texts.select("t", F.array(*plain).alias("plain"), F.array(*fast).alias("fast")).collect()
    for r in got:
        assert r["plain"] == r["fast"], r["t"]
    assert [i for i in range(len(plain)) if not any(r["plain"][i] for r in got)] == []
    for r in texts.select(*extract.all_fields(t).values(), *extract.all_fields(t, words=words).values()).limit(200).collect():
        assert r[: len(r) // 2] == r[len(r) // 2 :]


def test_null_text(spark):
    one = spark.createDataFrame([(None,)], "t string").select("t", rules.beginnings(F.col("t")).alias("words"))
    for words in (None, F.col("words")):
        got = one.select(*(c.alias(n) for n, c in extract.all_fields(F.col("t"), words=words).items())).first().asDict()
        assert {n: x for n, x in got.items() if x is not None} == {"objective": "效果研究", "outcome": "无效"}


def test_long_sentence(spark):
    """A sentence takes time in proportion to its length."""
    long = "one two three " * 5000
    texts = spark.createDataFrame([(1, long), (2, f"{long}. {long} side effect {long}."), (3, f"toxicity {long}")], "i int, t string")
    began = time.time()
    got = {r["i"]: r["x"] for r in texts.select("i", extract.adverse_events(F.col("t")).alias("x")).collect()}
    assert got == {1: None, 2: long[:150], 3: None}
    assert time.time() - began < 30


def test_rows_are_dealt_out(spark, sf_dir):
    """A file of one row group is no single task."""
    assert extract_row(spark, sf_dir).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
