"""Whole evaluations: load, search, judge, save. One job over a table of questions, with results, summary and report as files.

A folder of results holds `results` (JSON arrays, a case each, with its hits in order), `summary` and `gates` (a JSON array
each), `failures` (JSON arrays of the cases that missed, with the class of the miss) and `report/report.md`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.operators import evaluation, guided, search
from sparquill.operators.timing import Phases
from sparquill.plans.rules import Gate, Profile, Router
from sparquill.sources import sinks


def evaluate(spark: SparkSession, questions: DataFrame, vectors: DataFrame, corpus: DataFrame, out: str, router: Router, profile: Profile, gates: Iterable[Gate], title: str = "Evaluation") -> DataFrame:
    """Runs questions (id, query, expected_any of (law_key, section_num, moment), expected_none) with vectors (id, embedding)
    over corpus (id, src, section, moment, embedding), writes the files under out and returns the gates."""
    phases = Phases(spark)
    asked = questions.join(vectors.select("id", "embedding"), "id").select(F.col("id").alias("question_id"), F.col("query").alias("text"), "embedding", "expected_any", "expected_none")
    asked = phases.run("questions", asked)
    found = search.multi_source(asked, corpus, router, profile)
    hits = phases.run("search", found.join(corpus.select("id", F.col("src"), "section", "moment"), ["id", "src"]))
    wanted = F.transform(F.coalesce("expected_any", F.array()), lambda e: F.struct(e["law_key"].alias("src"), e["section_num"].cast("string").alias("section"), e["moment"].alias("moment")))
    want = asked.select("question_id", "text", wanted.alias("expected"), F.coalesce("expected_none", F.array().cast("array<string>")).alias("expected_none"))
    judged = evaluation.strict_routing(want, hits)
    c = F.col
    miss = evaluation.failure_class(c("expected"), c("top_src"), c("top_section"), c("top_moment"), c("pass_strict"), c("pass_routing"), c("top1_hit_strict"))
    listed = hits.groupBy("question_id").agg(F.sort_array(F.collect_list(F.struct("rank", "src", "id", "section", "moment", "score"))).alias("hits"))  # profile.limit of each
    cases = phases.run("cases", judged.withColumn("failure", F.when(~c("top1_hit_strict") | ~c("pass_strict"), miss)).join(listed, "question_id", "left"))
    cases = phases.latency(cases)
    summary = evaluation.rates(cases, pass_rate_strict="pass_strict", pass_rate_routing="pass_routing", top1_rate_strict="top1_hit_strict", top1_rate_routing="top1_hit_routing")
    summary = summary.join(cases.agg(F.count("*").alias("total"), F.coalesce(F.count_if("hn_violation"), F.lit(0)).alias("hn_violations")))  # a row each
    summary = phases.run("summary", summary)
    judged_gates = phases.run("gates", evaluation.gates(summary, gates))
    sinks.write_json_array(cases.drop("expected_none"), f"{out}/results")
    sinks.write_json_array(summary, f"{out}/summary")
    sinks.write_json_array(judged_gates, f"{out}/gates")
    sinks.write_json_array(cases.filter(~c("pass_strict")).select("question_id", "text", "failure", "top_src", "top_section", "top_moment"), f"{out}/failures")
    classes = evaluation.failure_summary(cases.filter("failure is not null").select(F.col("failure").alias("class"), F.coalesce("top_src", F.lit("none")).alias("pair")))
    parts = [("Summary", summary), ("Gates", judged_gates), ("Failures", classes), ("Phases", phases.table())]
    report = f"# {title}\n\n" + "\n\n".join(f"## {name}\n\n{evaluation.markdown(rows)}" for name, rows in parts) + "\n"
    sinks.write_files(spark.createDataFrame([("report.md", report)], "name string, content string"), f"{out}/report")
    return judged_gates


def autofill(spark: SparkSession, questions: DataFrame, vectors: DataFrame, corpus: DataFrame, out: str, router: Router, profile: Profile) -> DataFrame:
    """Fills the expectation of questions (id, query, source_file and whatever else) with the first hit of the full search and
    writes each question file again as <name>.autofill.json, whose rows have the status OK, or FAIL where nothing was found.
    A file of questions is written by one task. Returns (id, autofill_status, law_key, section_num, moment)."""
    asked = questions.join(vectors.select("id", "embedding"), "id", "left").select(F.col("id").alias("question_id"), F.col("query").alias("text"), "embedding")
    first = guided.first_hits(search.multi_source(asked.filter("embedding is not null"), corpus, router, profile)).join(corpus.select("id", "section", "moment"), "id")
    of = first.select(F.col("question_id").alias("id"), F.struct(F.col("src").alias("law_key"), F.col("section").cast("int").alias("section_num"), "moment").alias("hit"))
    kept = questions.drop("expected_any", "autofill_status").join(of, "id", "left")
    filled = kept.withColumn("expected_any", F.when(F.col("hit").isNull(), F.array().cast("array<struct<law_key:string,section_num:int,moment:string>>")).otherwise(F.array("hit"))).withColumn("autofill_status", F.when(F.col("hit").isNull(), "FAIL").otherwise("OK"))
    name = F.concat(F.regexp_replace("source_file", r"(\.autofill)?\.json$", ""), F.lit(".autofill.json"))
    rows = filled.drop("hit", "source_file")
    sets = filled.groupBy(name.alias("name")).agg(F.to_json(F.sort_array(F.collect_list(F.struct("id", *[c for c in rows.columns if c != "id"])))).alias("content"))
    sinks.write_files(sets, out)
    return filled.select("id", "autofill_status", "hit.law_key", "hit.section_num", "hit.moment")
