"""Catalog: evaluation, gates and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.operators import documents, evaluation, search
from sparquill.operators.timing import Phases
from sparquill.plans.catalog import CORPUS, questions, query, table
from sparquill.plans.graph_queries import SIGNALS
from sparquill.plans.rules import GATES_FINANCE, Gate

# Each benchmark question expects a neighbour of its own vector's label; it is not its own neighbour.
HITS_SQL = """q AS (SELECT b.item_id AS question_id, e.embedding::DOUBLE[] AS v, e.label FROM benchmark b JOIN embeddings e ON e.vec_id = b.item_id),
hits AS (SELECT question_id, e.vec_id AS id, CAST(e.label AS VARCHAR) AS section, CAST(e.vec_id % 2 AS VARCHAR) AS moment, round(list_dot_product(q.v, e.embedding::DOUBLE[]), 6) AS score,
                row_number() OVER (PARTITION BY question_id ORDER BY round(list_dot_product(q.v, e.embedding::DOUBLE[]), 6) DESC, e.vec_id) AS rank
         FROM q, embeddings e WHERE e.vec_id <> question_id QUALIFY rank <= 10),
asked AS (SELECT question_id, CAST(label AS VARCHAR) AS section, CASE WHEN question_id % 3 = 0 THEN CAST(question_id % 2 AS VARCHAR) END AS moment, question_id % 4 = 0 AS must,
                 'c' || (label % 3) AS category, CASE WHEN question_id % 5 = 0 THEN 'hard' ELSE 'base' END AS test_type, CASE WHEN question_id % 5 = 0 THEN CAST((label + 1) % 10 AS VARCHAR) END AS banned FROM q)"""


def cases_sql(k: str = "5", least: str = "0.05", grid: str = "") -> str:
    return f"""m AS (SELECT a.*, h.rank, h.score, h.id IS NOT NULL AND h.section = a.section AND (a.moment IS NULL OR h.moment = a.moment) AS match, coalesce(h.section = a.banned, false) AS bad{', g.*' if grid else ''}
      FROM asked a {grid} LEFT JOIN hits h ON h.question_id = a.question_id AND h.rank <= {k}),
cases AS (SELECT question_id, must, category, test_type{', k, min_score' if grid else ''}, CAST(min(CASE WHEN match AND score >= {least} THEN rank END) AS INT) AS first_rank, bool_or(match AND rank = 1) AS top1_hit, bool_or(bad AND rank = 1) AS hn_violation,
                 bool_or(match AND rank <= 3) AS hit3, max(CASE WHEN rank = 1 THEN score END) AS top1_score, first_rank IS NOT NULL AND NOT hn_violation AS passed, coalesce(1.0::DOUBLE / first_rank, 0) AS rr
          FROM m GROUP BY ALL)"""


def _hits(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    found = search.topk(questions(spark, d), vectors, 11, id_col="vec_id").filter("id <> question_id")
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("question_id").orderBy(F.desc("score"), "id"))
    rows = found.withColumn("rank", rank).filter("rank <= 10").join(vectors.select(F.col("vec_id").alias("id"), "label"), "id")
    return rows.select("question_id", "id", "rank", "score", F.col("label").cast("string").alias("section"), (F.col("id") % 2).cast("string").alias("moment"))


def _asked(spark: SparkSession, d: str) -> DataFrame:
    q, own = F.col("question_id"), F.col("label")
    rows = questions(spark, d).join(table(spark, d, "embeddings").select(F.col("vec_id").alias("question_id"), "label"), "question_id")
    expected = F.array(F.struct(own.cast("string").alias("section"), F.when(q % 3 == 0, (q % 2).cast("string")).alias("moment")))
    banned = F.when(q % 5 == 0, F.array(((own + 1) % 10).cast("string")))
    return rows.select("question_id", F.lit(5).alias("k"), F.lit(0.05).alias("min_score"), expected.alias("expected"), banned.alias("expected_none"), (q % 4 == 0).alias("must"), F.concat(F.lit("c"), (own % 3).cast("string")).alias("category"), F.when(q % 5 == 0, "hard").otherwise("base").alias("test_type"))


def _cases(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.cases(_asked(spark, d), _hits(spark, d))


@query(f"WITH {HITS_SQL}, {cases_sql()} SELECT question_id, passed, top1_hit, hn_violation, first_rank, round(rr, 6) AS rr FROM cases")
def eval_cases(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, d).select("question_id", "passed", "top1_hit", "hn_violation", "first_rank", F.round("rr", 6).alias("rr"))


def _rate(flag: str, of: str = "true") -> str:
    return f"round(coalesce(avg(CASE WHEN {of} THEN CAST({flag} AS DOUBLE) END), 0) + 1e-9, 4)"


METRICS_SQL = f"""count(*) AS total, {_rate('passed')} AS pass_rate_total, {_rate('passed', 'must')} AS pass_rate_must, {_rate('passed', 'NOT must')} AS pass_rate_should, {_rate('top1_hit')} AS top1_hit_rate,
{_rate('top1_hit', 'must')} AS top1_hit_rate_must, {_rate('top1_hit')} AS precision_at_1, {_rate('hit3')} AS precision_at_3, round(coalesce(avg(rr), 0) + 1e-9, 4) AS mrr, CAST(sum(CAST(hn_violation AS BIGINT)) AS BIGINT) AS hn_violations,
round(coalesce(avg(top1_score), 0) + 1e-9, 4) AS avg_top1_score, round(coalesce(median(top1_score), 0) + 1e-9, 4) AS median_top1_score"""


@query(f"WITH {HITS_SQL}, {cases_sql()} SELECT {METRICS_SQL} FROM cases")
def eval_metrics(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.metrics(_cases(spark, d))


@query(f"""WITH {HITS_SQL}, {cases_sql()} SELECT CASE WHEN grouping(category) = 0 THEN 'category' WHEN grouping(test_type) = 0 THEN 'test_type' ELSE 'all' END AS dimension,
CASE WHEN grouping(category) = 0 THEN category WHEN grouping(test_type) = 0 THEN test_type ELSE 'all' END AS value, count(*) AS total, {_rate('passed')} AS pass_rate FROM cases GROUP BY GROUPING SETS ((), (category), (test_type))""")
def eval_breakdown(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.breakdown(_cases(spark, d), ("category", "test_type"))


@query(f"""WITH {HITS_SQL}, g AS (SELECT k, s::DOUBLE AS min_score FROM (VALUES (3), (5), (10)) a(k), (VALUES (0.05), (0.2), (0.3)) b(s)), {cases_sql('g.k', 'min_score', 'CROSS JOIN g')}
SELECT k, min_score, count(*) AS total, {_rate('passed')} AS pass_rate_total, round(coalesce(avg(rr), 0) + 1e-9, 4) AS mrr FROM cases GROUP BY k, min_score""")
def eval_matrix(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.sweep(_asked(spark, d), _hits(spark, d), (3, 5, 10), (0.05, 0.2, 0.3))


GATES = (Gate("MUST", "pass_rate_must", ">=", 0.99), Gate("MUST top-1", "top1_hit_rate_must", ">=", 0.05), Gate("SHOULD", "pass_rate_should", ">=", 0.3), Gate("hard negatives", "hn_violations", "=", 0), Gate("MRR", "mrr", ">=", 0.1, False))


@query(f"WITH {HITS_SQL}, {cases_sql()}, x AS (SELECT {METRICS_SQL} FROM cases) " + " UNION ALL ".join(f"SELECT '{g.name}' AS gate, CAST({g.metric} AS DOUBLE) AS value, {g.threshold}::DOUBLE AS threshold, {g.metric} {g.op} {g.threshold}::DOUBLE AS passed, {str(g.required).lower()} AS required FROM x" for g in GATES))
def quality_gates(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.gates(evaluation.metrics(_cases(spark, d)), GATES)


@query(f"""WITH {HITS_SQL}, g AS (SELECT k, s::DOUBLE AS min_score FROM (VALUES (3), (5), (10)) a(k), (VALUES (0.05), (0.2), (0.3)) b(s)), {cases_sql('g.k', 'min_score', 'CROSS JOIN g')},
r AS (SELECT k, min_score, {_rate('passed')} AS pass_rate_total FROM cases GROUP BY k, min_score),
s AS (SELECT count(*) AS runs, round(avg(pass_rate_total) + 1e-9, 4) AS mean, round(min(pass_rate_total), 4) AS least, round(max(pass_rate_total), 4) AS greatest, round(coalesce(stddev_samp(pass_rate_total), 0) + 1e-9, 4) AS deviation FROM r)
SELECT *, round(greatest - least, 4) AS spread, round(greatest - least, 4) <= 0.02 AS stable FROM s""")
def stability(spark: SparkSession, d: str) -> DataFrame:
    """Over nine runs of the same questions, each with its own k and threshold."""
    return evaluation.stability(evaluation.sweep(_asked(spark, d), _hits(spark, d), (3, 5, 10), (0.05, 0.2, 0.3)), "pass_rate_total")


STRICT_SQL = f"""{HITS_SQL}, {CORPUS},
langs AS (SELECT doc_id, lang FROM documents), sh AS (SELECT h.*, l.lang AS src FROM hits h LEFT JOIN langs l ON l.doc_id = h.id),
own AS (SELECT q.question_id, CAST(q.label AS VARCHAR) AS section, l.lang AS src FROM q LEFT JOIN langs l ON l.doc_id = q.question_id),
x AS (SELECT question_id, 0 AS exp_no, src, section, CAST(question_id % 2 AS VARCHAR) AS moment FROM own UNION ALL SELECT question_id, 1, 'en', section, NULL FROM own),
p AS (SELECT x.*, h.rank, h.section = x.section AND (x.moment IS NULL OR h.moment = x.moment) AS strict FROM x JOIN sh h ON h.question_id = x.question_id AND h.src = x.src),
t AS (SELECT * FROM (SELECT *, min(CASE WHEN strict THEN exp_no END) OVER (PARTITION BY question_id) AS stop FROM p) WHERE stop IS NULL OR exp_no <= stop),
f AS (SELECT question_id, bool_or(strict) AS pass_strict, true AS pass_routing, bool_or(strict AND rank = 1) AS top1_hit_strict, arg_min(rank, exp_no * 1000 + rank) = 1 AS top1_hit_routing FROM t GROUP BY question_id),
s AS (SELECT o.question_id, coalesce(pass_strict, false) AS pass_strict, coalesce(pass_routing, false) AS pass_routing, coalesce(top1_hit_strict, false) AS top1_hit_strict, coalesce(top1_hit_routing, false) AS top1_hit_routing,
             coalesce(h.src IN ('fr'), false) AS hn_violation, o.src AS want_src, o.section AS want_section, h.src AS top_src, h.section AS top_section, h.moment AS top_moment
      FROM own o LEFT JOIN f USING (question_id) LEFT JOIN sh h ON h.question_id = o.question_id AND h.rank = 1)"""


def _strict(spark: SparkSession, d: str) -> DataFrame:
    langs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("src"))
    own = questions(spark, d).select("question_id").join(table(spark, d, "embeddings").select(F.col("vec_id").alias("question_id"), F.col("label").cast("string").alias("section")), "question_id")
    own = own.join(langs.withColumnRenamed("id", "question_id"), "question_id", "left")
    item = lambda src, moment: F.struct(src.alias("src"), F.col("section").alias("section"), moment.alias("moment"))
    asked = own.select("question_id", F.array(item(F.col("src"), (F.col("question_id") % 2).cast("string")), item(F.lit("en"), F.lit(None).cast("string"))).alias("expected"), F.array(F.lit("fr")).alias("expected_none"))
    return evaluation.strict_routing(asked, _hits(spark, d).join(langs, "id", "left"))


@query(f"WITH {STRICT_SQL} SELECT question_id, pass_strict, pass_routing, top1_hit_strict, top1_hit_routing, hn_violation FROM s")
def strict_routing(spark: SparkSession, d: str) -> DataFrame:
    return _strict(spark, d).select("question_id", "pass_strict", "pass_routing", "top1_hit_strict", "top1_hit_routing", "hn_violation")


@query(f"""WITH {STRICT_SQL}, k AS (SELECT CASE WHEN top_src IS NULL THEN 'A' WHEN top_src <> want_src THEN CASE WHEN pass_routing THEN 'D' ELSE 'A' END WHEN top_section <> want_section THEN CASE WHEN pass_strict THEN 'D' ELSE 'B' END
WHEN top_moment <> CAST(question_id % 2 AS VARCHAR) THEN CASE WHEN pass_strict THEN 'D' ELSE 'C' END WHEN pass_strict AND NOT top1_hit_strict THEN 'D' ELSE '?' END AS class FROM s) SELECT class, count(*) AS n FROM k GROUP BY class""")
def failure_classes(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    found = evaluation.failure_class(c("expected"), c("top_src"), c("top_section"), c("top_moment"), c("pass_strict"), c("pass_routing"), c("top1_hit_strict"))
    return _strict(spark, d).select(found.alias("class")).groupBy("class").agg(F.count("*").alias("n"))


ADV_SQL = f"""{HITS_SQL}, langs AS (SELECT doc_id, lang FROM documents), sh AS (SELECT h.*, l.lang AS src FROM hits h JOIN langs l ON l.doc_id = h.id),
a AS (SELECT b.item_id AS question_id, b.item_id % 4 = 0 AS must_abstain, {' OR '.join(f"contains(lower(text), '{s}')" for s in SIGNALS)} AS abstains, l.lang AS want FROM benchmark b JOIN q ON q.question_id = b.item_id JOIN langs l ON l.doc_id = b.item_id),
g AS (SELECT question_id, list(src ORDER BY rank) AS got, list(src ORDER BY rank) FILTER (rank <= 3) AS near FROM sh GROUP BY question_id),
c AS (SELECT a.*, list_contains(near, want) AS found, got[1] = 'es' AS trapped, list_contains(got, want) AS anywhere FROM a LEFT JOIN g USING (question_id)),
v AS (SELECT question_id, must_abstain, abstains, CASE WHEN must_abstain THEN abstains ELSE coalesce(found, false) END AS passed, NOT must_abstain AND coalesce(trapped, false) AS confusion_fail, NOT must_abstain AND NOT coalesce(found, false) AND coalesce(anywhere, false) AS near_miss FROM c)"""


def _adversarial(spark: SparkSession, d: str) -> DataFrame:
    langs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("src"))
    asked = questions(spark, d).join(langs.select(F.col("id").alias("question_id"), F.array("src").alias("expected_sources")), "question_id")
    asked = asked.select("question_id", "expected_sources", F.lit("es").alias("trap"), F.lit(3).alias("k_required"), (F.col("question_id") % 4 == 0).alias("must_abstain"), documents.abstain_signal(F.col("text"), SIGNALS, "\x00").isNotNull().alias("abstains"))
    return evaluation.adversarial_cases(asked, _hits(spark, d).join(langs, "id"))


@query(f"WITH {ADV_SQL} SELECT question_id, passed, confusion_fail, near_miss, (confusion_fail AND 'LAW' <> 'ABSTAIN') OR (must_abstain AND NOT abstains) AS case_fail FROM v")
def adversarial_cases(spark: SparkSession, d: str) -> DataFrame:
    no = F.lit(False)
    fail = evaluation.case_fail(no, no, F.col("confusion_fail"), F.lit("LAW"), F.col("must_abstain"), F.col("abstains"))
    return _adversarial(spark, d).select("question_id", "passed", "confusion_fail", "near_miss", fail.alias("case_fail"))


ADV_GATES = (Gate("confusion", "confusion_rate", "<=", 0.02), Gate("abstain", "abstain_rate", ">=", 0.9))


@query(f"""WITH {ADV_SQL}, m AS (SELECT round(coalesce(avg(CASE WHEN NOT must_abstain THEN CAST(confusion_fail AS DOUBLE) END), 0) + 1e-9, 4) AS c, round(coalesce(avg(CASE WHEN must_abstain THEN CAST(abstains AS DOUBLE) END), 1) + 1e-9, 4) AS a FROM v)
SELECT coalesce(c <= 0.02 AND a >= 0.9, true) AS overall_pass FROM m""")
def adversarial_gates(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.overall(evaluation.gates(evaluation.adversarial_metrics(_adversarial(spark, d)), ADV_GATES))


@query("""WITH s AS (SELECT l_suppkey, round(sum(l_quantity), 2) AS got, count(*) AS n FROM lineitem GROUP BY l_suppkey),
c AS (SELECT s_suppkey, s_suppkey % 5 = 0 AS abstain_expected, s_suppkey % 7 = 0 AS abstains, s_suppkey % 3 = 0 AS evidence_required, coalesce(n, 0) > 560 AS has_evidence, CASE WHEN s_suppkey % 2 = 0 THEN 'NUMERIC' ELSE 'TEXT' END AS expected_type,
             CASE WHEN s_suppkey % 11 <> 0 THEN 15000.0::DOUBLE END AS expected_numeric, CASE WHEN s_suppkey % 13 <> 0 THEN got END AS numeric_value FROM supplier LEFT JOIN s ON l_suppkey = s_suppkey),
r AS (SELECT *, CASE WHEN expected_type = 'NUMERIC' AND expected_numeric IS NOT NULL AND numeric_value IS NOT NULL THEN CASE WHEN abs(numeric_value - expected_numeric) > 500 THEN 'Numeric mismatch' END
                 WHEN expected_type = 'NUMERIC' AND numeric_value IS NULL AND NOT abstain_expected THEN 'No numeric value extracted' END AS n1,
            CASE WHEN evidence_required AND NOT has_evidence AND NOT abstain_expected THEN 'Missing table evidence' END AS n2,
            CASE WHEN abstain_expected AND NOT abstains THEN 'Should have abstained' WHEN NOT abstain_expected AND abstains THEN 'Should not have abstained' END AS n3 FROM c)
SELECT s_suppkey, coalesce(n1, n2, n3, '') AS fail_reason, coalesce(n1, n2, n3, '') = '' AS passed FROM r""")
def finance_cases(spark: SparkSession, d: str) -> DataFrame:
    sums = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.round(F.sum("l_quantity"), 2).alias("got"), F.count("*").alias("n"))
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select("s_suppkey").join(sums, "s_suppkey", "left").select(
        "s_suppkey", (k % 5 == 0).alias("abstain_expected"), (k % 7 == 0).alias("abstains"), (k % 3 == 0).alias("evidence_required"), (F.coalesce("n", F.lit(0)) > 560).alias("has_evidence"),
        F.when(k % 2 == 0, "NUMERIC").otherwise("TEXT").alias("expected_type"), F.when(k % 11 != 0, 15000.0).alias("expected_numeric"), F.when(k % 13 != 0, F.col("got")).alias("numeric_value"), F.lit(500.0).alias("tolerance"),
    )
    return evaluation.finance_cases(rows).select("s_suppkey", "fail_reason", "passed")


@query("""SELECT count(*) AS "rows", CAST(count(*) FILTER (doc_id IS NULL) AS BIGINT) AS missing, (SELECT count(*) FROM (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING count(*) > 1)) AS repeated,
(SELECT count(*) FROM (SELECT DISTINCT doc_id FROM labels) l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)) AS unknown_versions FROM labels""")
def label_audit(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "documents").select(F.col("doc_id").alias("version"))
    return evaluation.audit(table(spark, d, "labels"), "doc_id", "doc_id", known)


@query("""SELECT o_custkey, count(*) AS version_count, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderdate, o_orderkey) AS versions FROM orders GROUP BY o_custkey""")
def lineage(spark: SparkSession, d: str) -> DataFrame:
    found = evaluation.lineage(table(spark, d, "orders"), "o_custkey", "o_orderkey", "o_orderdate")
    return found.withColumn("versions", F.array_join(F.col("versions").cast("array<string>"), ","))


FINANCE_SQL = """s AS (SELECT l_suppkey, round(sum(l_quantity), 2) AS got FROM lineitem GROUP BY l_suppkey),
c AS (SELECT s_suppkey % 5 = 0 AS abstain, s_suppkey % 10 = 0 AS abstains, s_suppkey % 3 = 0 AS need, s_suppkey % 9 <> 0 AS evidence, s_suppkey % 4 = 0 AS calc, s_suppkey % 8 = 0 AS calced, s_suppkey % 6 <> 0 AS cited, s_suppkey % 2 = 0 AS num,
             CASE WHEN s_suppkey % 11 <> 0 THEN abs(got - 15000) <= 1500 END AS near, s_suppkey % 7 <> 0 AS passed FROM supplier LEFT JOIN s ON l_suppkey = s_suppkey),
m AS (SELECT round(coalesce(avg(CASE WHEN need AND NOT abstain THEN evidence::INT::DOUBLE END), 1) + 1e-9, 4) AS table_evidence_rate, round(coalesce(avg(CASE WHEN calc AND NOT abstain THEN calced::INT::DOUBLE END), 1) + 1e-9, 4) AS calc_trace_rate,
             round(coalesce(avg(CASE WHEN num AND NOT abstain THEN coalesce(near, false)::INT::DOUBLE END), 1) + 1e-9, 4) AS numeric_accuracy, round(coalesce(avg(CASE WHEN NOT abstain THEN cited::INT::DOUBLE END), 1) + 1e-9, 4) AS citation_coverage,
             round(coalesce(avg(CASE WHEN abstain THEN abstains::INT::DOUBLE END), 1) + 1e-9, 4) AS abstain_correct FROM c)"""


def gates_sql(gates: tuple[Gate, ...], row: str) -> str:
    """SELECTs of the gates from one row of metrics; a latency's value is measured, so it is not compared."""
    of = lambda g: ("NULL::DOUBLE", "true") if g.metric == "avg_latency_ms" else (f"{g.metric}::DOUBLE", f"{g.metric} {g.op} {g.threshold}::DOUBLE")
    return " UNION ALL ".join(f"SELECT '{g.name}' AS gate, {of(g)[0]} AS value, {g.threshold}::DOUBLE AS threshold, {of(g)[1]} AS passed, {str(g.required).lower()} AS required FROM {row}" for g in gates)


def measured(gates: DataFrame) -> DataFrame:
    """Gates for comparison: of a latency only that it was measured."""
    timed = F.lower("gate").startswith("latency")
    return gates.withColumn("passed", F.when(timed, F.col("value") > 0).otherwise(F.col("passed"))).withColumn("value", F.when(~timed, F.col("value")))


@query(f"WITH {FINANCE_SQL} " + " UNION ALL ".join(f"SELECT '{g.name}' AS gate, {g.metric} AS value, {g.threshold}::DOUBLE AS threshold, {g.metric} {g.op} {g.threshold}::DOUBLE AS passed, {str(g.required).lower()} AS required FROM m" for g in GATES_FINANCE))
def finance_gates(spark: SparkSession, d: str) -> DataFrame:
    sums = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.round(F.sum("l_quantity"), 2).alias("numeric_value"))
    k = F.col("s_suppkey")
    rows = table(spark, d, "supplier").select("s_suppkey").join(sums, "s_suppkey", "left").select(
        (k % 5 == 0).alias("abstain_expected"), (k % 10 == 0).alias("abstains"), (k % 3 == 0).alias("evidence_required"), (k % 9 != 0).alias("has_evidence"), (k % 4 == 0).alias("calc_required"), (k % 8 == 0).alias("has_calc"),
        (k % 6 != 0).alias("has_citation"), F.when(k % 2 == 0, "NUMERIC").otherwise("TEXT").alias("expected_type"), F.when(k % 11 != 0, 15000.0).alias("expected_numeric"), "numeric_value", F.lit(1500.0).alias("tolerance"),
        (k % 7 != 0).alias("passed"),
    )
    phases = Phases(spark)
    return evaluation.gates(evaluation.finance_metrics(phases.latency(phases.run("cases", rows))), GATES_FINANCE)


PARTS_SQL = "p AS (SELECT p_partkey, p_size, p_type, p_partkey % 40 AS version, CASE WHEN p_partkey % 6 = 0 THEN 'a' END AS suffix, CASE WHEN p_partkey % 50 = 0 THEN CAST(p_size AS VARCHAR) ELSE p_size || CASE WHEN p_partkey % 6 = 0 THEN 'a' ELSE '' END END AS section_id, CASE WHEN p_partkey % 9 = 0 THEN '  ' ELSE p_type END AS body FROM part)"


def _layer(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Parts as rows of a layer, and the versions (regions' nations) that its lineage knows."""
    k, suffix = F.col("p_partkey"), F.when(F.col("p_partkey") % 6 == 0, "a")
    size = F.col("p_size").cast("string")
    section = F.when(k % 50 == 0, size).otherwise(F.concat(size, F.coalesce(suffix, F.lit(""))))
    rows = table(spark, d, "part").select(
        (k % 1900).cast("string").alias("node_id"), (k % 40).cast("string").alias("finlex_version"), section.alias("section_id"), F.col("p_size").alias("section_num"), suffix.alias("section_suffix"), F.when(k % 9 == 0, "  ").otherwise(F.col("p_type")).alias("text"),
        F.struct(F.lit("x").alias("xml_path"), F.when(k % 17 != 0, "u").alias("finlex_url"), F.lit("p").alias("xpath")).alias("source"), "p_type",
    )
    versions = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("version"), F.when(F.col("n_nationkey") % 5 != 0, F.col("n_name")).alias("source_xml"))
    return rows, versions


@query(f"""WITH {PARTS_SQL}, c AS (SELECT p_partkey % 1900 AS id, count(*) AS n FROM p GROUP BY id)
SELECT (SELECT count(*) FROM p) AS "rows", 0::BIGINT AS missing, (SELECT count(*) FROM c WHERE n > 1) AS repeated, (SELECT count(DISTINCT version) FROM p WHERE version NOT IN (SELECT n_nationkey FROM nation)) AS unknown_versions,
(SELECT count(*) FROM p WHERE section_id <> p_size || coalesce(suffix, '')) AS bad_sections, (SELECT round(avg(CASE WHEN contains(p_type, 'STEEL') OR section_id IN ('1', '2a') THEN 1.0::DOUBLE ELSE 0 END) + 1e-9, 4) FROM p) AS hit_rate,
(SELECT count(*) FROM nation WHERE n_nationkey % 5 = 0) AS lineage_missing_source""")
def layer_audit(spark: SparkSession, d: str) -> DataFrame:
    rows, versions = _layer(spark, d)
    return evaluation.full_audit(rows, versions, F.contains("p_type", F.lit("STEEL")) | F.col("section_id").isin("1", "2a"))


@query(f"""WITH {PARTS_SQL} SELECT 'missing_columns' AS "check", 2::BIGINT AS failed UNION ALL SELECT 'missing_source', count(*) FILTER (p_partkey % 17 = 0) FROM p UNION ALL SELECT 'empty_text', count(*) FILTER (p_partkey % 9 = 0) FROM p
UNION ALL SELECT 'repeated_ids', count(*) - count(DISTINCT p_partkey % 1900) FROM p UNION ALL SELECT 'unknown_versions', count(DISTINCT version) FROM p WHERE version NOT IN (SELECT n_nationkey FROM nation)""")
def layer_validation(spark: SparkSession, d: str) -> DataFrame:
    rows, versions = _layer(spark, d)
    return evaluation.validate(rows, versions, ("node_id", "text", "source", "law", "in_force"))
