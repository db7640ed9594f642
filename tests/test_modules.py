"""Workbooks, run state, clients, errors and the record-level operators on small examples."""

from __future__ import annotations

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from corvane.functions import age, evidence, phrases
from corvane.operators import clients, model_call, parsing, relational, resilience
from corvane.sources import state, tables, workbook


def test_workbook(spark, tmp_path):
    path = str(tmp_path / "a.xlsx")
    rows = spark.createDataFrame([(1, "a < b & c", None), (2, "", ""), (3, " two  words ", "é\n2")], "n int, t string, u string").orderBy("n")
    assert workbook.write(path, {"Other": rows.select("n"), "Results": rows.select(F.col("t").alias("Text "), "u")}) == {"Other": 3, "Results": 3}
    got = workbook.read(spark, path)
    assert got.columns == ["Text", "u", "seq"]
    assert [tuple(r) for r in got.orderBy("seq").collect()] == [("a < b & c", "", 0), ("two words", "é 2", 2)]
    assert workbook.read(spark, path, "other").count() == 3
    assert workbook.resolve(["Record ID", "PMID"], {"id": ["recordid"], "note": ["note"]}, ("note",)) == {"id": "Record ID"}
    with pytest.raises(ValueError, match="note"):
        workbook.resolve(["Record ID"], {"note": ["note"]})


def test_log(spark, tmp_path):
    log = state.Log(str(tmp_path / "run" / "log.jsonl"))
    assert log.about() == {} and not log.has_progress()
    with pytest.raises(ValueError, match="no log"):
        log.check(model="m")
    log.reset(source_path=str(tmp_path / "x.txt"), provider="p", model="m")
    log.check(source_path=str(tmp_path / "x.txt"), provider="p", model="m")
    with pytest.raises(ValueError, match="model"):
        log.check(model="other")
    log.batch(1, [{"Record ID": "1", "Age": "a"}, {"Record ID": "1", "Age": "b"}], {"prompt_tokens": 3, "total_tokens": 5}, [1, 2])
    log.no_row(7, batch_index=2)
    with log.path.open("a") as file:
        file.write("broken {\n")
    assert log.has_progress() and log.has_rows()
    found = tables.log(spark, str(log.path)).withColumn("seq", F.monotonically_increasing_id())
    assert sorted(r[0] for r in relational.completed(found, by_usage=True).collect()) == [1, 2, 7]
    assert [r["Age"] for r in relational.rows_of_log(found, ["Record ID", "Age"], last_by="Record ID").collect()] == ["b"]
    assert tuple(relational.usage_totals(found).first()) == (3, 0, 5)


def test_documents(tmp_path):
    path = str(tmp_path / "f.json")
    assert state.failures([]) is None and state.write_document(path, None) == ""
    state.write_document(path, state.failures([{"record_ids": [1, 2]}, {"record_ids": [3]}]))
    assert state.read_document(path)["failed_record_count"] == 3
    out = str(tmp_path / "out.xlsx")
    manifest = state.rescue_manifest(out, "s.txt", [3, 1, 3], kind="x")
    assert manifest["record_ids"] == [1, 3] and state.rescue_manifest(out, "s", []) is None
    state.write_document(str(state.sidecar(out)), manifest)
    assert state.update_manifest(str(state.sidecar(out)), "completed", rows=2)["metadata"] == {"kind": "x", "rows": 2}
    assert state.copy_sidecar(out, str(tmp_path / "new.xlsx")).endswith("new_population_rescue.json")
    assert state.copy_sidecar(str(tmp_path / "none.xlsx"), out) == ""


def test_names(tmp_path):
    assert state.source_stem("/a/Step1_my_corpus_25010112_cleaned.txt") == "my_corpus"
    assert state.run_folder("out", "my.txt").parts[-2:] == ("Step1", "step1_run_my")
    assert state.run_folder("out/Step1/step1_run_my", "my.txt").parts[-2:] == ("Step1", "step1_run_my")
    assert state.with_prefix("/a/b.xlsx", "Step2B_") == "/a/Step2B_b.xlsx" == state.with_prefix("/a/Step2B_b.xlsx", "Step2B_")
    assert state.safe_name(" a b/c ") == "a_b_c" and state.safe_name("??") == "output"
    assert state.newest(str(tmp_path), ("a",), "none") == "none"
    (tmp_path / "a1.xlsx").write_text("")
    assert state.newest(str(tmp_path), ("a",)).endswith("a1.xlsx")
    (tmp_path / "api_keys.json").write_text(json.dumps({"p": "k", "q": "PASTE_HERE"}))
    assert state.keys([str(tmp_path)], {"p": "NO_SUCH_P", "q": "NO_SUCH_Q"}) == {"p": "k", "q": ""}


def test_halves():
    calls = []

    def call(items):
        calls.append(len(items))
        if len(items) > 2:
            raise RuntimeError("request too large")
        return list(items)

    assert resilience.in_halves(range(7), call, lambda a, b: a + b) == list(range(7))
    with pytest.raises(RuntimeError):
        resilience.in_halves(range(7), call, lambda a, b: a + b, depth=1)
    with pytest.raises(ValueError):
        resilience.in_halves([1, 2], lambda x: (_ for _ in ()).throw(ValueError("else")), lambda a, b: a)
    assert resilience.splittable(resilience.MalformedOutput("x"), 2) and not resilience.splittable(resilience.MalformedOutput("x"), 1)
    assert resilience.added({"prompt_tokens": 2}, {"prompt_tokens": None, "total_tokens": 4}) == {"prompt_tokens": 2, "completion_tokens": 0, "total_tokens": 4}


def test_brake():
    now = [100.0]
    brake = resilience.Brake(9, clock=lambda: now[0])
    assert brake.left() == 0 and brake.refused("try again in 5s", 0) > 5
    brake.refused("429", 1)
    brake.refused("429", 1)
    assert brake.cap == 4
    for _ in range(7):
        brake.refused("429", 1)
    assert brake.cap == 3
    now[0] += 300
    for _ in range(10):
        brake.relax()
    assert brake.cap > 3 and brake.left() == 0
    with pytest.raises(resilience.Cancelled):
        resilience.pause(5, stopped=lambda: True)
    assert resilience.guarded(resilience.Settings(5, -1, 500), parallel=True) == resilience.Settings(30, 0, 100)
    assert resilience.guarded(resilience.Settings(60, 1, 50), True, resilience.Settings(300, 4, 5)) == resilience.Settings(300, 4, 5)
    assert resilience.guarded(resilience.Settings(60, 1, 50), False).concurrency == 1


class _Model(BaseHTTPRequestHandler):
    """Answers ``chat`` and ``generate``; refuses the first call, and batches of more than two records."""

    calls: list = []

    def do_POST(self):
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.calls.append(self.path)
        text = asked["messages"][0]["content"] if "messages" in asked else asked["contents"][0]["parts"][0]["text"]
        ids = [line.split()[2] for line in text.splitlines() if line.startswith("=== RECORD")]
        if len(self.calls) == 1:
            self.reply(503, {"error": {"message": "temporarily unavailable"}})
        elif len(ids) > 2:
            self.reply(413, {"error": {"message": "request too large"}})
        else:
            answer = "Here: " + json.dumps({"rows": [{"source_index": i} for i in ids]})
            chat = {"choices": [{"message": {"content": [{"text": answer}]}}], "usage": {"prompt_tokens": 7, "completion_tokens": 2, "total_tokens": 9}}
            self.reply(200, chat if "messages" in asked else {"candidates": [{"content": {"parts": [{"text": answer}]}}]})

    def reply(self, code, body):
        raw = json.dumps(body).encode()
        self.send_response(code)
        self.end_headers()
        self.wfile.write(raw)

    def log_message(self, *args):
        pass


@pytest.mark.parametrize("dialect", ["chat", "generate"])
def test_client(dialect):
    _Model.calls = []
    server = HTTPServer(("127.0.0.1", 0), _Model)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        backend = clients.HttpBackend(f"http://127.0.0.1:{server.server_port}", "short", dialect, aliases={"short": "long-name"})
        records = [{"record_id": i, "text": f"text {i}"} for i in range(5)]
        assert [r["source_index"] for r in model_call.parse_rows(backend.call(records))] == list("01234")
        assert backend.usage.estimated == (dialect == "generate") and backend.usage.counts["prompt_tokens"] > 0
        assert any("long-name" in x for x in _Model.calls) or dialect == "chat"
    finally:
        server.shutdown()
    for text, wanted in (('[{"a": 1}, 2]', [{"a": 1}]), ('x {"rows": {"a": 1}} y', [{"a": 1}]), ('```json\n{"rows": 5}\n```', [])):
        assert clients.payload(text)["rows"] == wanted
    for text in ("none", "{broken}", "5"):
        with pytest.raises(resilience.MalformedOutput):
            clients.payload(text)
    assert clients.resolve_model("m-1", ["models/m-1-preview", "m-1-preview-2"]) == "m-1-preview"
    assert clients.traits_payload([{"row_id": 1, "population_raw": " a  b ", "population_focus": ""}]) == "=== ROW 1 ===\nPopulation: a b"


def test_lookup(spark):
    rows = spark.createDataFrame([(1, "T", "J", "2001", "", ""), (2, "", "", "", "77", ""), (3, "", "J", "", "", "")], "record_id long, t string, j string, y string, p string, n string")
    found = rows.select("record_id", clients.lookup(*(F.col(c) for c in "tjypn")).alias("lookup"))
    assert [tuple(r["lookup"]) for r in found.orderBy("record_id").collect()] == [("title", "Title: T; Journal: J; Year: 2001"), ("pmid", "77"), ("none", "")]
    answers = spark.createDataFrame([(1, "x")], "record_id long, row string")
    noted = clients.with_notes(found, answers, "record_id", "unsearchable", "missing")
    assert sorted((r["record_id"], r["row"], r["note"]) for r in noted.collect()) == [(1, "x", ""), (2, None, "missing"), (3, None, "unsearchable")]


def test_passes_call_once(spark, tmp_path):
    """Every record is sent once for each pass in which it is open."""
    counted = tmp_path / "calls"
    counted.mkdir()

    class Counting(model_call.RuleBackend):
        def call(self, batch):
            import uuid

            (counted / uuid.uuid4().hex).write_text(" ".join(str(x["record_id"]) for x in batch))
            return super().call(batch)

    texts = spark.createDataFrame([(i, f"word {i}") for i in range(40)], "record_id long, text string")
    got = model_call.extract_in_passes(texts, Counting(drop_every=7), (10, 1)).collect()
    assert len(got) == 40 and len({r["record_id"] for r in got}) == 40
    sent = [int(x) for f in counted.iterdir() for x in f.read_text().split()]
    assert len(sent) == 40 + sum(r["pass"] == 2 for r in got)


def test_contexts(spark):
    text = "[1]  J\nPMID: 5  Year: 2010\nA study of walking for people with low mood\n\nPATIENTS: Nurses aged 30-40 years. RESULTS: Scores fell. CONCLUSIONS: It helps."
    rows = parsing.parse_records(spark.createDataFrame([(1, text), (2, None)], "record_id long, record string"))
    t, s = F.col("title"), F.col("sections")
    one = rows.select(
        parsing.population_context(t, s).alias("p"),
        parsing.evidence_context(t, s).alias("e"),
        parsing.rescue_context(t, s).alias("r"),
        parsing.prompt_text(F.col("nct_id"), s).alias("m"),
        parsing.rescue_prompt(t, s).alias("q"),
    ).collect()
    title = "A study of walking for people with low mood"
    assert tuple(one[0])[:3] == (f"{title} Nurses aged 30-40 years.", "Scores fell. It helps.", f"{title} Nurses aged 30-40 years.")
    assert one[0]["m"] == "PATIENTS: Nurses aged 30-40 years.\nRESULTS: Scores fell.\nCONCLUSIONS: It helps."
    assert one[0]["q"] == f"TITLE: {title}\nPATIENTS: Nurses aged 30-40 years."
    assert tuple(one[1]) == ("", "", "", "", "")
    size = parsing.corpus_size(rows.where("record is not null"), "record", 10, "12345678").first()
    assert size["records"] == 1 and size["batches"] == 1 and size["tokens"] == -(-len(text) // 4) + 2


def test_output_rows(spark):
    cells = dict.fromkeys((*evidence.INPUTS, *evidence.CONTEXTS), "")
    told = {"source_index": "record 1", "intervention": "Sertraline 50 mg", "intervention_type": "drug", "comparator": "TAU", "outcome_direction": "improved", "population_raw": "Nurses"}
    answers = spark.createDataFrame([(1, {**cells, **told}), (1, {**cells, "source_index": "1"}), (9, {**cells, **told})], "record_id long, x map<string,string>")
    answers = answers.select("record_id", *(F.col("x")[n].alias(n) for n in evidence.INPUTS))
    contexts = spark.createDataFrame([(1, "A phase 2 trial in moderate depression.", "", "")], "record_id long, context string, population_context string, evidence_context string")
    got = parsing.output_rows(answers, contexts).collect()
    assert len(got) == 1
    row = got[0].asDict()
    assert (row["intervention"], row["comparator"], row["phase"], row["outcome_direction"]) == ("Sertraline|||50 mg", "Usual care", "Phase 2", "Positive")
    assert (row["population_raw"], row["severity"], row["population_status"]) == ("Nurses", "moderate depression", "main_pass_plus_row_local_severity")


def test_age_report(spark):
    got = age.report(spark.createDataFrame([("6 months",), ("youth",), (None,)], "value string"))
    assert got.columns == ["value", *age.REPORT]
    rows = {r["value"]: r for r in got.collect()}
    assert (rows["6 months"]["age_source_kind"], rows["6 months"]["age_original_unit"], rows["6 months"]["age_reported_scale_years"]) == ("reported_numeric", "months", 0.0)
    assert (rows["youth"]["age_source_kind"], rows["youth"]["age_stage_detail"], rows["youth"]["age_inferred_upper_years"]) == ("mixed_term", "Adolescent+YoungAdult", 25.0)
    assert rows[None]["age_source_kind"] == "missing"


def test_rule_files():
    """Every rule file reads, and every pattern compiles."""
    for path in sorted(phrases.FOLDER.glob("*.tsv")):
        assert path.read_text(encoding="utf-8").startswith("# Fixed values: ")
        assert phrases.rows(path.stem)
