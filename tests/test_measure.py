"""Measured latency, metadata as VARIANT, clustered tables, drivers that write files."""

from __future__ import annotations

import json
import time
from pathlib import Path

from pyspark.sql import functions as F

from sparquill import staging
from sparquill.operators import drivers, enrich, evaluation
from sparquill.operators.timing import Phases
from sparquill.plans.rules import GATES_CROSS, LANGUAGE_PROFILE, LANGUAGES
from sparquill.plans.statute_rules import GATES_ADVERSARIAL
from sparquill.sources import files


def test_phases_count_rows_and_time(spark):
    phases = Phases(spark)
    began = time.perf_counter()
    a = phases.run("first", spark.range(100))
    phases.run("second", a.filter("id < 7"))
    took = 1000 * (time.perf_counter() - began)
    rows = phases.table().collect()
    assert [(r.phase, r.n_rows) for r in rows] == [("first", 100), ("second", 7)] and 0 < sum(r.elapsed_ms for r in rows) <= took
    cases = phases.latency(spark.range(4)).collect()
    assert len(cases) == 4 and all(abs(r.latency_ms - sum(x.elapsed_ms for x in rows) / 4) < 1e-6 for r in cases)
    assert phases.latency(spark.range(0)).count() == 0 and phases.run("none", spark.range(0)).count() == 0


def test_staged_tables_can_be_cleared(spark):
    old = list(staging._PATHS)
    staging._PATHS.clear()
    held = staging.stage(spark.range(3), "held")
    folder = Path(held.inputFiles()[0].removeprefix("file://")).parent.parent
    assert folder.is_dir() and held.count() == 3
    staging.clear(spark)
    assert not folder.exists() and not staging._PATHS
    staging._PATHS.extend(old)


def test_lists_of_any_form_are_decoded(spark):
    rows = spark.createDataFrame([(1, '["a", "b"]'), (2, json.dumps('["a", "b"]')), (3, json.dumps("[broken")), (4, "5"), (5, "null"), (6, '{"a": 1}'), (7, "[]"), (8, '["a", 2, null]'), (9, json.dumps("plain"))], "k int, j string")
    got = {r.k: r.v for r in rows.select("k", enrich.decoded_list(F.parse_json("j")).alias("v")).collect()}
    assert got == {1: ["a", "b"], 2: ["a", "b"], 3: [], 4: [], 5: [], 6: [], 7: [], 8: ["a", "2", None], 9: []}
    none = spark.createDataFrame([(1,)], "k int").select(enrich.decoded_list(F.lit(None).cast("variant")).alias("v"))
    assert none.first().v == []
    flat = enrich.flat_metadata(spark.createDataFrame([(["a", None], 1, "x", True, {"k": 1})], "a array<string>, b int, c string, d boolean, e map<string,int>"), "a", "b", "c", "d", "e")
    assert tuple(flat.first()) == ('["a",null]', 1, "x", True, "{k -> 1}")


def test_filters_on_a_clustered_table_skip_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200_000).select("id", F.pmod(F.xxhash64("id"), F.lit(50)).alias("label"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
    files.write_clustered(rows.repartition(4), path, "label", ("id",), 1 << 20)

    def read(df):
        df = df.select(F.sum(F.length("body")), F.count("*"))
        n = df.first()[1]
        plan, found = df._jdf.queryExecution().executedPlan(), []
        stack = [plan]
        while stack:
            node = stack.pop()
            if node.nodeName().startswith("Scan parquet"):
                found.append(node.metrics().apply("numOutputRows").value())
            for name in ("finalPhysicalPlan", "plan"):
                if hasattr(node, name) and node.nodeName() in ("AdaptiveSparkPlan", "ShuffleQueryStage"):
                    try:
                        stack.append(getattr(node, name)())
                    except Exception:  # noqa: BLE001  a node without it
                        pass
            kids = node.children()
            stack += [kids.apply(i) for i in range(kids.size())]
        return n, sum(found)

    table = spark.read.parquet(path)
    n, scanned = read(table.filter("label between 3 and 5"))
    assert n == rows.filter("label between 3 and 5").count() and n <= scanned < 100_000
    n, scanned = read(table.filter("id = 123456"))
    assert n == 1 and scanned < 100_000


def test_adversarial_gates_of_all_kinds(spark):
    rows = spark.createDataFrame([(False, True, False, False, False, 10.0), (False, False, False, True, False, 20.0), (True, False, True, False, True, 30.0), (True, True, False, False, False, 40.0)], "must_abstain boolean, confusion_fail boolean, abstains boolean, hallucinated_evidence boolean, version_drift boolean, latency_ms double")
    m = evaluation.adversarial_metrics(rows)
    r = m.first()
    assert (r.confused, r.to_answer, r.hallucinated, r.drifted, r.abstained, r.to_abstain, r.case_fails, r.total, r.avg_latency_ms, r.confusion_rate, r.abstain_rate) == (1, 2, 1, 1, 1, 2, 4, 4, 25.0, 0.5, 0.5)
    assert {g.gate: g.passed for g in evaluation.gates(m, GATES_ADVERSARIAL).collect()} == dict.fromkeys(("CONFUSION_FAIL_RATE", "HALLU_EVIDENCE", "VERSION_DRIFT", "ABSTAIN_CORRECT"), False)
    plain = evaluation.adversarial_metrics(rows.limit(0).drop("hallucinated_evidence", "version_drift", "latency_ms")).first()
    assert (plain.confused, plain.hallucinated, plain.confusion_rate, plain.abstain_rate, plain.total) == (0, 0, 0.0, 1.0, 0)


def test_drivers_write_results_and_question_files(spark, tmp_path):
    corpus = spark.createDataFrame([(1, "en", "5", "1", [1.0, 0.0]), (2, "de", "6", "2", [0.8, 0.6]), (3, "fr", "7", None, [0.0, 1.0])], "id int, src string, section string, moment string, embedding array<double>")
    asked = [{"id": "a", "query": "the thing her", "expected_any": [{"law_key": "en", "section_num": 5, "moment": "1"}], "expected_none": ["fr"]}, {"id": "b", "query": "sch ung", "expected_any": [{"law_key": "de", "section_num": 1, "moment": None}], "expected_none": []}, {"id": "c", "query": "none", "expected_any": [], "expected_none": None}]
    (tmp_path / "q.json").write_text(json.dumps(asked))
    (tmp_path / "q2.json").write_text(json.dumps([{"id": "d", "query": "no vector"}]))
    questions = files.questions(spark, [str(tmp_path / "q.json"), str(tmp_path / "q2.json")])
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.6, 0.8]), ("c", [1.0, 0.0])], "id string, embedding array<double>")
    out = str(tmp_path / "out")
    gates = {r.gate: r for r in drivers.evaluate(spark, questions, vectors, corpus, out, LANGUAGES, LANGUAGE_PROFILE, GATES_CROSS, "Small").collect()}
    assert set(gates) == {g.name for g in GATES_CROSS} and gates["latency_150ms"].value > 0 and not gates["pass_rate_strict_95"].passed
    load = lambda name: [x for p in (tmp_path / f"out/{name}").glob("*.json") for x in json.loads(p.read_text())]
    results = {x["question_id"]: x for x in load("results")}
    assert results["a"]["pass_strict"] and results["a"]["hits"][0]["id"] == 1 and not results["b"]["pass_strict"] and results["b"]["failure"] == "B"
    assert {x["question_id"]: x["failure"] for x in load("failures")} == {"b": "B", "c": "X"} and load("summary")[0]["total"] == 3 and len(load("gates")) == 3
    report = (tmp_path / "out/report/report.md").read_text()
    assert report.startswith("# Small\n\n## Summary") and "## Phases" in report and "search" in report
    filled = {r.id: r for r in drivers.autofill(spark, questions, vectors, corpus, str(tmp_path / "filled"), LANGUAGES, LANGUAGE_PROFILE).collect()}
    assert filled["a"].law_key == "en" and filled["a"].section_num == 5 and filled["d"].autofill_status == "FAIL"
    again = files.questions(spark, [], [str(tmp_path / f"filled/{n}.autofill.json") for n in ("q", "q2")])
    assert {r.id for r in again.collect()} == {"a", "b", "c"}
