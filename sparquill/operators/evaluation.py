"""Cases, metrics, breakdowns, gates and audits: every report is an aggregation of one table of cases."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.plans.rules import Gate


def normal_section(section: Column) -> Column:
    return F.lower(F.regexp_replace(section.cast("string"), " ", ""))


def hit_matches(section: Column, moment: Column, expected_section: Column, expected_moment: Column) -> Column:
    """Sections equal without blanks and case; moments equal unless none is expected."""
    return (normal_section(section) == normal_section(expected_section)) & (expected_moment.isNull() | (moment.cast("string") == expected_moment.cast("string")))


def cases(questions: DataFrame, hits: DataFrame, key: str = "question_id") -> DataFrame:
    """A row a question (key, k, min_score and whatever else it has, expected: array of (section, moment), expected_none:
    array of sections) with passed, top1_hit, hn_violation, first_rank, rr, top1_score, hit3.

    Hits (key, rank, section, moment, score) beyond k do not count; the first match is ranked among all of a question's
    hits but must reach min_score; the first hit's match does not. A forbidden first hit fails the case and leaves rr.
    """
    got = hits.join(questions.select(key, "k", "min_score", "expected", "expected_none"), key).filter(F.col("rank") <= F.col("k"))
    match = F.exists("expected", lambda e: hit_matches(F.col("section"), F.col("moment"), e["section"], e["moment"]))
    forbidden = F.exists(F.coalesce("expected_none", F.array().cast("array<string>")), lambda s: normal_section(s) == normal_section(F.col("section")))
    got = got.withColumn("match", match)
    per = got.groupBy(key).agg(
        F.min(F.when(F.col("match") & (F.col("score") >= F.col("min_score")), F.col("rank"))).alias("first_rank"),
        F.coalesce(F.bool_or(F.col("match") & (F.col("rank") == 1)), F.lit(False)).alias("top1_hit"),
        F.coalesce(F.bool_or(forbidden & (F.col("rank") == 1)), F.lit(False)).alias("hn_violation"),
        F.coalesce(F.bool_or(F.col("match") & (F.col("rank") <= 3)), F.lit(False)).alias("hit3"),
        F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("top1_score"),
    )
    rows = questions.join(per, key, "left").fillna(False, ["top1_hit", "hn_violation", "hit3"])
    rr = F.coalesce(F.lit(1.0) / F.col("first_rank"), F.lit(0.0))
    return rows.withColumn("passed", F.col("first_rank").isNotNull() & ~F.col("hn_violation")).withColumn("rr", rr).drop("expected", "expected_none")


def rates(case_rows: DataFrame, **flags: str) -> DataFrame:
    """One row: for each name=flag the share of cases with the flag, and avg_latency_ms where cases have a latency_ms."""
    latency = [four(F.coalesce(F.avg("latency_ms"), F.lit(0.0))).alias("avg_latency_ms")] if "latency_ms" in case_rows.columns else []
    return case_rows.agg(*[rate(F.col(flag)).alias(name) for name, flag in flags.items()], *latency)


def pair_key(source_file: Column, prefix: str = "questions_cross_", suffix: str = r"(\.autofill)?\.json") -> Column:
    """The pair of sources that a question file's name stands for."""
    return F.regexp_replace(source_file, f"^{prefix}|{suffix}$", "")


def four(value: Column) -> Column:
    """Four digits, halves up: a sum's last bit, which follows the order of its rows, does not decide."""
    return F.round(value + F.lit(1e-9), 4)


def rate(flag: Column, of: Column | None = None) -> Column:
    """Share of rows (of those where `of` holds) with the flag, four digits; 0 where there are none."""
    value = flag.cast("double")
    return four(F.coalesce(F.avg(value if of is None else F.when(of, value)), F.lit(0.0)))


def metrics(case_rows: DataFrame, *by: str) -> DataFrame:
    """One row of metrics over all cases or a row for each value of `by`."""
    mean = lambda c: four(F.coalesce(F.avg(c), F.lit(0.0)))
    return case_rows.groupBy(*by).agg(
        F.count("*").alias("total"),
        rate(F.col("passed")).alias("pass_rate_total"),
        rate(F.col("passed"), F.col("must")).alias("pass_rate_must"),
        rate(F.col("passed"), ~F.col("must")).alias("pass_rate_should"),
        rate(F.col("top1_hit")).alias("top1_hit_rate"),
        rate(F.col("top1_hit"), F.col("must")).alias("top1_hit_rate_must"),
        rate(F.col("top1_hit")).alias("precision_at_1"),
        rate(F.col("hit3")).alias("precision_at_3"),
        mean("rr").alias("mrr"),
        F.sum(F.col("hn_violation").cast("long")).alias("hn_violations"),
        mean("top1_score").alias("avg_top1_score"),
        four(F.coalesce(F.median("top1_score"), F.lit(0.0))).alias("median_top1_score"),
    )


def breakdown(case_rows: DataFrame, keys: Iterable[str]) -> DataFrame:
    """(dimension, value, total, pass_rate) for all cases and for each value of each key, in one pass of grouping sets."""
    keys = list(keys)
    sets = [[], *[[F.col(k)] for k in keys]]
    grouped = case_rows.groupingSets(sets, *[F.col(k) for k in keys]).agg(F.count("*").alias("total"), rate(F.col("passed")).alias("pass_rate"), *[F.grouping(k).alias(f"no_{k}") for k in keys])
    dimension, value = F.lit("all"), F.lit("all")
    for k in keys:
        dimension, value = F.when(F.col(f"no_{k}") == 0, k).otherwise(dimension), F.when(F.col(f"no_{k}") == 0, F.col(k).cast("string")).otherwise(value)
    return grouped.select(dimension.alias("dimension"), value.alias("value"), "total", "pass_rate")


def sweep(questions: DataFrame, hits: DataFrame, ks: Iterable[int], min_scores: Iterable[float], key: str = "question_id") -> DataFrame:
    """Metrics for every (k, min_score), all from one set of hits of the largest k: configurations are rows."""
    grid = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(float(s)).alias("min_score")) for k in ks for s in min_scores])
    many = questions.drop("k", "min_score").withColumn("c", F.explode(grid)).select("*", "c.*").drop("c")
    many = many.withColumnRenamed(key, "question").withColumn(key, F.struct("question", "k", "min_score"))
    spread = hits.withColumnRenamed(key, "question").withColumn("c", F.explode(grid)).withColumn(key, F.struct("question", "c.k", "c.min_score")).drop("c", "question")
    return metrics(cases(many.drop("question"), spread, key), "k", "min_score").select("k", "min_score", "total", "pass_rate_total", "mrr")


def gates(metric_row: DataFrame, rules: Iterable[Gate]) -> DataFrame:
    """(gate, value, threshold, passed, required) for a one-row table of metrics; a gate whose metric is null is left out."""
    compare = {">=": lambda v, t: v >= t, "<=": lambda v, t: v <= t, "<": lambda v, t: v < t, "=": lambda v, t: v == t}
    each = [F.struct(F.lit(g.name).alias("gate"), F.col(g.metric).cast("double").alias("value"), F.lit(float(g.threshold)).alias("threshold"), compare[g.op](F.col(g.metric).cast("double"), F.lit(float(g.threshold))).alias("passed"), F.lit(g.required).alias("required")) for g in rules]
    return metric_row.select(F.explode(F.array(*each)).alias("g")).select("g.*").filter("value is not null")


def overall(gate_rows: DataFrame) -> DataFrame:
    return gate_rows.agg(F.coalesce(F.bool_and(F.col("passed") | ~F.col("required")), F.lit(True)).alias("overall_pass"))


def stability(runs: DataFrame, metric: str, most: float = 0.02) -> DataFrame:
    """Mean, least, most, sample deviation (0 for one run) and range of a metric over runs, and whether the range is small."""
    v = F.col(metric)
    agg = runs.agg(F.count("*").alias("runs"), four(F.avg(v)).alias("mean"), F.round(F.min(v), 4).alias("least"), F.round(F.max(v), 4).alias("greatest"), four(F.coalesce(F.stddev_samp(v), F.lit(0.0))).alias("deviation"))
    spread = F.round(F.col("greatest") - F.col("least"), 4)
    return agg.withColumn("spread", spread).withColumn("stable", spread <= most)


def strict_routing(questions: DataFrame, hits: DataFrame, key: str = "question_id") -> DataFrame:
    """pass_strict, pass_routing, top1_hit_strict, top1_hit_routing, hn_violation, matched per question.

    expected is an ordered array of (src, section, moment), expected_none one of sources. Expectations are tried in order up
    to the first with a strict match; the routed top-1 counts only if the first routing match at all is the first hit.
    """
    exp = questions.select(key, F.posexplode("expected").alias("exp_no", "e"))
    pairs = exp.join(hits, key).filter(F.col("src") == F.col("e.src"))
    strict = (F.col("section").cast("string") == F.col("e.section").cast("string")) & (F.col("e.moment").isNull() | (F.col("moment").cast("string") == F.col("e.moment").cast("string")))
    pairs = pairs.withColumn("strict", strict)
    stop = F.min(F.when(F.col("strict"), F.col("exp_no"))).over(Window.partitionBy(key))
    tried = pairs.withColumn("stop", stop).filter(F.col("stop").isNull() | (F.col("exp_no") <= F.col("stop")))
    per = tried.groupBy(key).agg(
        F.bool_or("strict").alias("pass_strict"),
        F.lit(True).alias("pass_routing"),
        F.coalesce(F.bool_or(F.col("strict") & (F.col("rank") == 1)), F.lit(False)).alias("top1_hit_strict"),
        (F.min_by("rank", F.struct("exp_no", "rank")) == 1).alias("top1_hit_routing"),
    )
    top = hits.filter("rank = 1").select(key, F.col("src").alias("top_src"), F.col("section").alias("top_section"), F.col("moment").alias("top_moment"))
    flags = ["pass_strict", "pass_routing", "top1_hit_strict", "top1_hit_routing"]
    rows = questions.join(per, key, "left").join(top, key, "left").fillna(False, flags)
    return rows.withColumn("hn_violation", F.coalesce(F.array_contains("expected_none", F.col("top_src")), F.lit(False)))


def failure_class(expected: Column, top_src: Column, top_section: Column, top_moment: Column, pass_strict: Column, pass_routing: Column, top1_strict: Column) -> Column:
    """X nothing expected, A wrong source, B wrong section, C wrong moment, D right hit below the first; against the first
    expectation."""
    first = F.get(expected, F.lit(0))
    later = lambda ok, letter: F.when(ok, "D").otherwise(letter)
    return (
        F.when(F.size(F.coalesce(expected, F.array())) == 0, "X")
        .when(top_src.isNull(), "A")
        .when(top_src != first["src"], later(pass_routing, "A"))
        .when(top_section.cast("string") != first["section"].cast("string"), later(pass_strict, "B"))
        .when(~top_moment.cast("string").eqNullSafe(first["moment"].cast("string")), later(pass_strict, "C"))
        .when(pass_strict & ~top1_strict, "D")
        .otherwise("?")
    )


def adversarial_cases(questions: DataFrame, hits: DataFrame, key: str = "question_id") -> DataFrame:
    """passed, confusion_fail and near_miss of questions with expected_sources, trap, k_required, must_abstain, abstains."""
    per = hits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "src"))).alias("got"))
    rows = questions.join(per, key, "left").withColumn("got", F.coalesce("got", F.array().cast("array<struct<rank:int,src:string>>")))
    srcs = F.transform("got", lambda h: h["src"])
    among = F.arrays_overlap(F.transform(F.filter("got", lambda h: h["rank"] <= F.col("k_required")), lambda h: h["src"]), F.col("expected_sources"))
    rows = rows.withColumn("found", F.coalesce(among, F.lit(False)))
    judged = ~F.col("must_abstain") & (F.size("expected_sources") > 0)
    passed = F.when(F.col("must_abstain"), F.col("abstains")).when(judged, F.col("found")).otherwise(True)
    confused = judged & F.coalesce(F.get(srcs, F.lit(0)) == F.col("trap"), F.lit(False))
    near = judged & ~F.col("found") & F.coalesce(F.arrays_overlap(srcs, F.col("expected_sources")), F.lit(False))
    return rows.withColumn("passed", passed).withColumn("confusion_fail", confused).withColumn("near_miss", near).drop("got", "found")


def case_fail(hallucinated: Column, drifted: Column, confused: Column, category: Column, abstain_expected: Column, abstains: Column) -> Column:
    return hallucinated | drifted | (confused & (category != "ABSTAIN")) | (abstain_expected & ~abstains)


def adversarial_metrics(case_rows: DataFrame) -> DataFrame:
    """Confusion among cases that should answer (0 where there are none) and correct abstentions (1 where none is expected), as
    counts and shares; the counts of hallucinated evidence and of version drift, where cases have these flags, and of failed
    cases, and the mean latency, where they have one."""
    answer, abstain = ~F.col("must_abstain"), F.col("must_abstain")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in case_rows.columns else F.lit(False)
    counted = lambda c: F.coalesce(F.count_if(c), F.lit(0)).alias
    category = F.coalesce(F.col("category"), F.lit("")) if "category" in case_rows.columns else F.when(abstain, "ABSTAIN").otherwise("")
    failed = case_fail(flag("hallucinated_evidence"), flag("version_drift"), F.col("confusion_fail"), category, abstain, F.col("abstains"))
    latency = [four(F.coalesce(F.avg("latency_ms"), F.lit(0.0))).alias("avg_latency_ms")] if "latency_ms" in case_rows.columns else []
    return case_rows.agg(
        counted(answer & F.col("confusion_fail"))("confused"), counted(answer)("to_answer"), counted(flag("hallucinated_evidence"))("hallucinated"), counted(flag("version_drift"))("drifted"),
        counted(abstain & F.col("abstains"))("abstained"), counted(abstain)("to_abstain"), counted(failed)("case_fails"), *latency,
        four(F.coalesce(F.avg(F.when(answer, F.col("confusion_fail").cast("double"))), F.lit(0.0))).alias("confusion_rate"),
        four(F.coalesce(F.avg(F.when(abstain, F.col("abstains").cast("double"))), F.lit(1.0))).alias("abstain_rate"),
        F.count("*").alias("total"),
    )


def finance_cases(questions: DataFrame) -> DataFrame:
    """passed and fail_reason of questions with abstains, abstain_expected, has_evidence, evidence_required, expected_type,
    expected_numeric, tolerance and numeric_value; a later check's reason replaces an earlier one's."""
    abstain = F.when(F.col("abstain_expected") & ~F.col("abstains"), "Should have abstained").when(~F.col("abstain_expected") & F.col("abstains"), "Should not have abstained")
    evidence = F.when(F.col("evidence_required") & ~F.col("has_evidence") & ~F.col("abstain_expected"), "Missing table evidence")
    numeric, both = F.col("expected_type") == "NUMERIC", F.col("expected_numeric").isNotNull() & F.col("numeric_value").isNotNull()
    number = F.when(numeric & both, F.when(F.abs(F.col("numeric_value") - F.col("expected_numeric")) > F.col("tolerance"), "Numeric mismatch")).when(numeric & F.col("numeric_value").isNull() & ~F.col("abstain_expected"), "No numeric value extracted")
    return questions.withColumn("fail_reason", F.coalesce(number, evidence, abstain, F.lit(""))).withColumn("passed", F.col("fail_reason") == "")


def finance_metrics(case_rows: DataFrame) -> DataFrame:
    """The five rates of finance cases (those of finance_cases and calc_required, has_calc, has_citation, latency_ms); a rate
    of no cases is 1, but for the pass rate and latency, which are 0."""
    c, answer = F.col, ~F.col("abstain_expected")
    share = lambda ok, of: F.coalesce(F.avg(F.when(of, F.coalesce(ok, F.lit(False)).cast("double"))), F.lit(1.0))
    right = F.abs(c("numeric_value") - c("expected_numeric")) <= c("tolerance")
    return case_rows.agg(
        four(share(c("has_evidence"), c("evidence_required") & answer)).alias("table_evidence_rate"),
        four(share(c("has_calc"), c("calc_required") & answer)).alias("calc_trace_rate"),
        four(share(right, (c("expected_type") == "NUMERIC") & answer)).alias("numeric_accuracy"),
        four(share(c("has_citation"), answer)).alias("citation_coverage"),
        four(share(c("abstains"), c("abstain_expected"))).alias("abstain_correct"),
        rate(c("passed")).alias("pass_rate"),
        four(F.coalesce(F.avg("latency_ms"), F.lit(0.0))).alias("avg_latency_ms"),
        F.count("*").alias("total"),
    )


def category_rates(case_rows: DataFrame, categories: Iterable[str]) -> DataFrame:
    """metrics() and pass_rate_<category> for each of the categories (dashes as underscores; null where it has no cases)."""
    each = [four(F.avg(F.when(F.col("category") == k, F.col("passed").cast("double")))).alias(f"pass_rate_{k.replace('-', '_')}") for k in categories]
    return metrics(case_rows).crossJoin(case_rows.agg(*each))  # a row each


def audit(rows: DataFrame, id_col: str, version_col: str | None = None, versions: DataFrame | None = None) -> DataFrame:
    """rows, missing ids, repeated ids and versions that the lineage (column `version`) does not know, in one row."""
    counted = rows.groupBy(id_col).agg(F.count("*").alias("n"))
    base = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col(id_col).isNull(), F.col("n"))), F.lit(0)).alias("missing"), F.count(F.when((F.col("n") > 1) & F.col(id_col).isNotNull(), 1)).alias("repeated"))
    if versions is None:
        return base
    lost = rows.select(F.col(version_col).alias("version")).distinct().join(versions.select("version").distinct(), "version", "left_anti").agg(F.count("*").alias("unknown_versions"))
    return base.crossJoin(lost)  # one row each


def full_audit(rows: DataFrame, versions: DataFrame, inside: Column, id_col: str = "node_id", version_col: str = "finlex_version") -> DataFrame:
    """audit() with bad_sections (id that is not number and suffix), lineage_missing_source, and the hit_rate of a domain
    filter (`inside`, a condition on rows). versions: version, source_xml."""
    whole = F.concat(F.col("section_num").cast("string"), F.coalesce("section_suffix", F.lit("")))
    counts = rows.agg(F.count(F.when(~F.coalesce(F.col("section_id") == whole, F.lit(False)), 1)).alias("bad_sections"), four(F.coalesce(F.avg(F.coalesce(inside, F.lit(False)).cast("double")), F.lit(0.0))).alias("hit_rate"))
    lineage_rows = versions.agg(F.count(F.when(F.coalesce("source_xml", F.lit("")) == "", 1)).alias("lineage_missing_source"))
    return audit(rows, id_col, version_col, versions).crossJoin(counts).crossJoin(lineage_rows)  # one row each


def validate(rows: DataFrame, versions: DataFrame, required: Iterable[str], source_keys: Iterable[str] = ("xml_path", "finlex_url", "xpath"), id_col: str = "node_id", version_col: str = "finlex_version") -> DataFrame:
    """(check, failed) over all rows of a layer: columns that the schema lacks, rows without a field of source, rows of empty
    text, ids that repeat, and versions for which the tree has no file."""
    columns = {f.name: f.dataType for f in rows.schema.fields}
    lacking = [k for k in required if k not in columns]
    held = getattr(columns.get("source"), "fieldNames", list)()
    keys = list(source_keys)
    no_source = F.lit(True) if not set(keys) <= set(held) else reduce(lambda a, b: a | b, (F.col(f"source.{k}").isNull() for k in keys))
    empty = F.coalesce(F.trim(F.col("text").cast("string")), F.lit("")) == "" if "text" in columns else F.lit(True)
    per_row = rows.agg(F.count(F.when(no_source, 1)).alias("source"), F.count(F.when(empty, 1)).alias("text"))
    twice = rows.groupBy(id_col).agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("ids"))
    lost = rows.select(F.col(version_col).alias("version")).filter("version is not null").distinct().join(versions.select("version").distinct(), "version", "left_anti").agg(F.count("*").alias("versions"))
    one = per_row.crossJoin(twice).crossJoin(lost).withColumn("rows", F.lit(len(lacking)).cast("long"))  # one row each
    checks = [("missing_columns", "rows"), ("missing_source", "source"), ("empty_text", "text"), ("repeated_ids", "ids"), ("unknown_versions", "versions")]
    return one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col(c).alias("failed")) for name, c in checks])).alias("c")).select("c.*")


def check(audited: DataFrame) -> None:
    """Raises ValueError if an audit found anything missing, repeated or unknown."""
    found = {k: v for k, v in audited.first().asDict().items() if k not in ("rows", "hit_rate") and v}
    if found:
        raise ValueError(f"audit failed: {found}")


def lineage(versions: DataFrame, key: str, version: str, at: str) -> DataFrame:
    """(key, version_count, latest, versions): versions ascending in time, then by name; the latest is the last."""
    order = F.struct(F.col(at).alias("at"), F.col(version).alias("v"))
    grouped = versions.groupBy(key).agg(F.array_sort(F.collect_list(order)).alias("all"), F.count("*").alias("version_count"))
    return grouped.select(key, "version_count", F.element_at(F.col("all.v"), -1).alias("latest"), F.col("all.v").alias("versions"))


def latest_version(paths: DataFrame, path: str = "path", prefix: str = "fin@") -> DataFrame:
    """The row whose folder has the greatest number after the prefix (0 where it is none)."""
    number = F.coalesce(F.regexp_extract(F.col(path), f"{prefix}([^/]*)", 1).try_cast("bigint"), F.lit(0))
    return paths.filter(F.contains(F.col(path), F.lit(prefix))).agg(F.max_by(F.col(path), number).alias(path))


def markdown(table: DataFrame, most: int = 1000) -> str:
    """A small result as a Markdown table; one of more than `most` rows raises ValueError rather than being cut."""
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows: write it as a table")
    lines = ["| " + " | ".join(table.columns) + " |", "|" + "---|" * len(table.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows])


def top_sources(questions: DataFrame, hits: DataFrame, most: int = 3, key: str = "question_id") -> DataFrame:
    """questions (key, expected_sources) with passed: an expected source among the first hits."""
    got = hits.filter(F.col("rank") <= most).groupBy(key).agg(F.collect_set("src").alias("got"))
    rows = questions.join(got, key, "left")
    return rows.withColumn("passed", F.coalesce(F.arrays_overlap("got", "expected_sources"), F.lit(False))).drop("got")


def verdict(case_rows: DataFrame, tiers: tuple[tuple[int, str], ...] = ((18, "excellent"), (15, "good"), (12, "fair"))) -> DataFrame:
    """(passed, total, verdict): the first tier whose number of passed cases is reached."""
    agg = case_rows.agg(F.sum(F.col("passed").cast("long")).alias("passed"), F.count("*").alias("total"))
    out = F.lit("poor")
    for least, name in reversed(tiers):
        out = F.when(F.col("passed") >= least, name).otherwise(out)
    return agg.withColumn("verdict", out)


def graph_cases(questions: DataFrame, primary: DataFrame, path: DataFrame, support: DataFrame, key: str = "question_id") -> DataFrame:
    """primary_pass, path_pass, support_pass of questions (key, want: struct(src, section, moment) with nulls for what does not
    matter, wants_refs, wants_exceptions, wants_other_law). primary: key, src, section, moment of the first hit; path: key,
    relation, target of every edge followed; support: key, node_id."""
    first = primary.select(key, "src", F.col("section").cast("string").alias("section"), F.col("moment").cast("string").alias("moment"))
    edges = path.groupBy(key).agg(F.bool_or(F.col("relation").isin("REFERS_TO", "EXCEPTS")).alias("has_ref"), F.bool_or(F.startswith("target", F.lit("external:"))).alias("has_external"))
    nodes = support.groupBy(key).agg(F.count("*").alias("n_support"))
    rows = questions.join(first, key, "left").join(edges, key, "left").join(nodes, key, "left")
    same = lambda a, b: b.isNull() | F.coalesce(a == b, F.lit(False))
    primary_pass = same(F.col("src"), F.col("want.src")) & same(F.col("section"), F.col("want.section").cast("string")) & same(F.col("moment"), F.col("want.moment").cast("string"))
    has = lambda c: F.coalesce(F.col(c), F.lit(False))
    support_ok = (F.coalesce("n_support", F.lit(0)) > 0) | (F.col("wants_other_law") & has("has_external"))
    return rows.select(
        key,
        (F.col("src").isNotNull() & primary_pass).alias("primary_pass"),
        (~F.col("wants_refs") | has("has_ref")).alias("path_pass"),
        (~(F.col("wants_refs") | F.col("wants_exceptions")) | support_ok).alias("support_pass"),
    )


def evidence_cases(questions: DataFrame, law_hits: DataFrame, doc_hits: DataFrame, key: str = "question_id") -> DataFrame:
    """law_pass, doc_pass, evidence_pass of questions (key, want_section, want_moment, section_pattern, node_type, metric_name,
    page_from, page_to, terms). The document passes if any hit meets any of the conditions given, or on any hit if none is
    given; the evidence if any hit's text or title holds a term, or there are no terms or no hits."""
    law = law_hits.join(questions.select(key, "want_section", "want_moment"), key).groupBy(key).agg(F.bool_or(hit_matches(F.col("section"), F.col("moment"), F.col("want_section"), F.col("want_moment"))).alias("law_pass"))
    asked = questions.select(key, "section_pattern", "node_type", "metric_name", "page_from", "page_to", "terms")
    docs = doc_hits.withColumnRenamed("node_type", "hit_type").join(asked, key)
    body = F.lower(F.concat_ws(" ", "text", "title"))
    wanted = F.col("section_pattern").isNotNull() | F.col("node_type").isNotNull() | F.col("metric_name").isNotNull() | F.col("page_from").isNotNull()
    pattern = F.concat(F.lit("(?iu)"), F.col("section_pattern"))
    conditions = [F.coalesce(F.regexp_like(F.concat_ws("\n", "title", "node_id", "text"), pattern), F.lit(False)), F.coalesce(F.col("hit_type") == F.col("node_type"), F.lit(False)), F.coalesce(F.contains(body, F.lower("metric_name")), F.lit(False)), F.coalesce(F.col("page_num").between(F.col("page_from"), F.col("page_to")), F.lit(False))]
    met = conditions[0] | conditions[1] | conditions[2] | conditions[3]
    held = F.exists("terms", lambda t: F.contains(body, F.lower(t)))
    doc = docs.groupBy(key).agg(F.bool_or(~wanted | met).alias("doc_pass"), F.bool_or(held).alias("held"))
    rows = questions.join(law, key, "left").join(doc, key, "left")
    no_terms = F.size(F.coalesce("terms", F.array().cast("array<string>"))) == 0
    return rows.select(key, F.coalesce("law_pass", F.lit(False)).alias("law_pass"), F.coalesce("doc_pass", F.lit(False)).alias("doc_pass"), (no_terms | F.col("held").isNull() | F.col("held")).alias("evidence_pass"))


def failure_summary(classified: DataFrame, pair: str = "pair") -> DataFrame:
    """(dimension, value, n): failures by class and by pair of sources, in one pass."""
    grouped = classified.groupingSets([[F.col("class")], [F.col(pair)]], F.col("class"), F.col(pair)).agg(F.count("*").alias("n"), F.grouping("class").alias("no_class"))
    return grouped.select(F.when(F.col("no_class") == 0, "class").otherwise("pair").alias("dimension"), F.when(F.col("no_class") == 0, F.col("class")).otherwise(F.col(pair)).alias("value"), "n")
