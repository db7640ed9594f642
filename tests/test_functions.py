"""Worked examples of the text functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corvane.functions import age, arms, extract, standard, text
from corvane.operators import model_call, records
from corvane.sources import sinks, tables


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "t string").select(expression(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("8-12 weeks; 6 months", 6.0), ("90 days", 3.0), ("6 weeks", 1.5), ("1 year", 12.0), ("12-month", None), (None, None), ("", None)],
)
def test_follow_up(spark, given, wanted):
    assert one(spark, given, standard.follow_up_months) == wanted


@pytest.mark.parametrize(
    ("given", "wanted"),
    [("mild to moderate", [2, 1]), ("mild-to-severe", [3, 1]), ("mild to severe", [3, 2, 1]), ("PHQ-9 >= 10", [3, 2]), ("first-episode", []), (None, [])],
)
def test_severity(spark, given, wanted):
    assert one(spark, given, standard.severity_codes) == wanted


@pytest.mark.parametrize(("given", "wanted"), [("60% Female", 0.4), ("45% Male + 55% Female", 0.45), ("Male + Female", None), ("male", 1.0)])
def test_gender(spark, given, wanted):
    got = one(spark, given, standard.male_proportion)
    assert got == wanted or abs(got - wanted) < 1e-9


def test_ethnicity(spark):
    assert {r["label"]: r["share"] for r in one(spark, "50% White + Black", standard.ethnicity_shares)} == {"White": 0.5, "Black": 0.5}
    assert [r["label"] for r in one(spark, "non-Hispanic white", standard.ethnicity_shares)] == ["White"]
    assert one(spark, None, standard.ethnicity_shares) == []


@pytest.mark.parametrize(("given", "wanted"), [("Pregnant || Alcohol use history", [1, 2]), ("Veterans", [6]), ("", [])])
def test_social(spark, given, wanted):
    assert one(spark, given, standard.social_codes) == wanted


@pytest.mark.parametrize(("given", "wanted"), [("1,234", 1234), ("30-40", 3040), ("none", None)])
def test_sample_digits(spark, given, wanted):
    assert one(spark, given, standard.sample_digits) == wanted


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("18-65", [0, 0, 18, 65, 0]),
        ("45.2+/-10.1", [45.2, 10.1, 0, 0, 0]),
        ("Median 40", [40, 0, 0, 0, 0]),
        ("65+", [0, 0, 65, 0, 0]),
        ("Older adults", [0, 0, 60, 79, 0]),
        ("Students", [0, 0, 0, 0, 0]),
        ("6 months", [0.5, 0, 0, 0, 0]),
    ],
)
def test_age(spark, given, wanted):
    assert one(spark, given, lambda c: age.vector(age.parse(c))) == wanted


def test_labels(spark):
    assert one(spark, "major depressive disorder || anxiety", standard.diseases) == ["MDD", "Depression generic", "Anxiety/comorbid anxiety"]
    assert one(spark, "", standard.diseases) == ["Unclassified"]
    assert [one(spark, x, arms.control_term) for x in ("TAU", "waiting-list", "normal saline")] == ["Usual care", "Waitlist", "Placebo"]
    assert one(spark, "[0,0,18,65,0]", standard.vector_nonzero) is True
    assert one(spark, "[0,0]", standard.vector_nonzero) is False


def test_text(spark):
    assert spark.range(1).select(text.ordered_dedupe(F.array(*map(F.lit, ["B", "a", "b", "A"])))).first()[0] == ["B", "a"]
    assert [one(spark, x, text.token_estimate) for x in ("123456789", "", None)] == [3, 1, 1]
    assert one(spark, "a  b\n", text.clean) == "a b"
    assert one(spark, "no significant difference", extract.outcome) == "无效"
    assert one(spark, "P < 0.05 and p=.03", extract.p_values) == "P < 0.05; p=.03"
    assert one(spark, "mean = 25", extract.sample_sizes) == "25"


def test_records(spark):
    corpus = "1. J A. 2004.\n\nTitle.\n\n2. J B. 2005.\n\nOther.\n3. not a start"
    assert one(spark, corpus, records.split_numbered) == ["1. J A. 2004.\n\nTitle.", "2. J B. 2005.\n\nOther.\n3. not a start"]
    ruled = "====\n[1]  J\nx\n====\n[2]  K\ny"
    assert one(spark, ruled, records.split_marked) == ["[1]  J\nx", "[2]  K\ny"]


def test_model_call(spark):
    texts = spark.createDataFrame([(i, f"word {i}") for i in range(25)], "record_id long, text string")
    got = model_call.extract_in_passes(texts, model_call.RuleBackend(drop_every=7, fail_over=3)).collect()
    assert sorted(r["record_id"] for r in got) == list(range(25))
    assert all(r["pass"] > 0 for r in got)
    assert model_call.parse_rows("no json") == []
    assert model_call.parse_rows('x [{"a": 1}] y') == [{"a": 1}]


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Journal , Outcome\n J  x ,Positive\n")
    (tmp_path / "b.tsv").write_text("Journal\tSample\nK\t12\n")
    got = tables.evidence(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.tsv")])
    assert got.columns == ["Journal", "Outcome", "Source File", "Sample"]
    assert sorted(r["Journal"] for r in got.collect()) == ["J x", "K"]
    with pytest.raises(ValueError, match="indication"):
        tables.resolve(["Journal", "Outcome"])
    (tmp_path / "log.jsonl").write_text('{"type":"row","record_id":3}\nnot json\n{"type":"usage"}\n')
    assert tables.log(spark, str(tmp_path / "log.jsonl")).count() == 2
    assert sinks.manifest(got.where("Journal = 'none'"), "Journal", "s") == ""


def test_streaming(spark, tmp_path):
    from corvane.streaming import incremental

    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "N = 30 patients"), (1, "N = 30 patients"), (2, "sertraline")], "record_id long, text string").write.parquet(source)
    query = incremental.run(incremental.read_records(spark, source), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(60)
    got = {r["record_id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == {1, 2} and got[1]["sample_size"] == "30" and got[2]["drugs"] == "sertraline"
