"""Catalog: the statutes' own rules over text that is generated from their terms, so that every value decides some row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparquill.operators import documents, enrich, evaluation, rerank, routing, search
from sparquill.plans import rules, statute_rules
from sparquill.plans.catalog import SQL, _any, _terms, diverse_sql, merge_sql, query, route_sql, spread, table
from sparquill.plans.rules import GATES_CROSS, GATES_GOLDEN, GATES_V3, PROBLEM_CATEGORIES, PROFILES, STATUTE_BOOSTS, STATUTES

#: Every term that a rule of the statutes looks for, each once.
TERMS = tuple(dict.fromkeys((
    *(t for ts in STATUTES.keywords.values() for t in ts), *STATUTES.anchors, *(t for t, _ in STATUTES.explicit), *(t for t, _ in STATUTES.numbers), *(t for t, _, _ in rules.STATUTE_GUARDS_14), *rules.STATUTE_MISMATCH,
    *(t for ts, *_ in (*STATUTE_BOOSTS.boosts, *STATUTE_BOOSTS.penalties) for t in ts), *STATUTE_BOOSTS.overlap_terms, *(t for ts in statute_rules.MUNICIPAL_ANCHOR_TERMS.values() for t in ts),
    *statute_rules.MUNICIPAL_CHAPTER_TAGS, *statute_rules.MUNICIPAL_KEYWORD_TAGS, *statute_rules.COMPANY_TERMS, *statute_rules.MUNICIPAL_TERMS, *(t for _, ts, _ in statute_rules.MAPPING_RULES for t in ts),
)))
N = len(TERMS)
#: Steps through the terms: a row's text has the term of its own number and four others.
STEPS = ((1, 0), (7, 3), (11, 5), (13, 8), (5, 1))
SOURCES = STATUTES.sources


def _listed(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _pick(values: tuple[str, ...], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(at, F.lit(len(values))).cast("int"))


def asked(spark: SparkSession, d: str) -> DataFrame:
    """(question_id, text): a row a part. A plain third has two terms, so that few matches occur too."""
    n = F.col("p_partkey")
    said = [_pick(TERMS, n * a + b) for a, b in STEPS]
    return spread(table(spark, d, "part").select("p_partkey"), "p_partkey").select(n.alias("question_id"), F.when(n % 3 == 0, F.concat_ws(" ", *said[:2])).otherwise(F.concat_ws(" ", *said)).alias("text"))


_SAID = [f"t[(p_partkey * {a} + {b}) % {N} + 1]" for a, b in STEPS]
ASKED = f"""asked AS (SELECT p_partkey AS question_id, text, lower(text) AS low FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN concat_ws(' ', {", ".join(_SAID[:2])}) ELSE concat_ws(' ', {", ".join(_SAID)}) END AS text FROM part, (SELECT {_listed(TERMS)} AS t)))"""


@query(f"WITH {ASKED}, {route_sql(STATUTES)} SELECT question_id, src, round(weight, 6) AS weight, route_pos FROM weights")
def statute_routing(spark: SparkSession, d: str) -> DataFrame:
    return routing.route(asked(spark, d), STATUTES).withColumn("weight", F.round("weight", 6))


def _found(spark: SparkSession, d: str) -> DataFrame:
    """(question_id, src, id, score, src_rank): four hits of each statute for each question, about the thresholds."""
    hits = F.array(*[F.struct(F.lit(s).alias("src"), F.lit(i).alias("i"), F.lit(r).alias("src_rank")) for i, s in enumerate(SOURCES) for r in range(1, 5)])
    rows = asked(spark, d).select("question_id", F.explode(hits).alias("h")).select("question_id", "h.*")
    score = F.round(F.lit(0.36) + F.pmod(F.col("question_id") * 31 + F.col("i") * 17 + F.col("src_rank") * 7, F.lit(40)) / 100 - F.col("src_rank") / 1000, 6)
    return rows.select("question_id", "src", (F.col("i") * 10 + F.col("src_rank")).alias("id"), score.alias("score"), "src_rank")


FOUND = f"""found AS (SELECT question_id, low, s[i + 1] AS src, i * 10 + r AS id, round(0.36::DOUBLE + ((question_id * 31 + i * 17 + r * 7) % 40)::DOUBLE / 100 - r::DOUBLE / 1000, 6) AS score_original, r AS src_rank
FROM asked, (SELECT {_listed(SOURCES)} AS s), (SELECT unnest(range(6)) AS i), (SELECT unnest(range(1, 5)) AS r))"""
ROUTED = tuple(n for n in PROFILES if n != "adversarial")


def _profile_sql() -> str:
    one = PROFILES["plain"]
    ctes = [ASKED, FOUND, route_sql(STATUTES), f"budgets AS (SELECT *, greatest({one.min_k}, CAST(ceil({one.total_k}::DOUBLE * weight) AS INT)) AS k, row_number() OVER (PARTITION BY question_id ORDER BY weight DESC, route_pos) AS router_place FROM weights)"]
    ctes.append("taken AS (SELECT found.*, route_pos, router_place FROM found JOIN budgets USING (question_id, src) WHERE src_rank <= k)")
    parts = []
    for name in ROUTED:
        p = PROFILES[name]
        ctes.append(merge_sql(p, STATUTES.core, f"m_{name}"))
        if p.diversity_gap is not None:
            ctes.append(diverse_sql(p, f"m_{name}", f"f_{name}"))
        parts.append(f"SELECT '{name}' AS profile, question_id, CAST(rank AS INT) AS rank, src, CAST(id AS INT) AS id, score FROM {'m' if p.diversity_gap is None else 'f'}_{name} WHERE rank <= {p.limit}")
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(parts)


@query(_profile_sql())
def statute_profiles(spark: SparkSession, d: str) -> DataFrame:
    """Every routed profile over the same hits."""
    questions, found = asked(spark, d), _found(spark, d)
    parts = []
    for name in ROUTED:
        near = search.within_budget(found, questions, STATUTES, PROFILES[name])
        merged = search.merge(near, questions, PROFILES[name], STATUTES.core)
        parts.append(merged.select(F.lit(name).alias("profile"), "question_id", "rank", "src", "id", "score"))
    return reduce(DataFrame.unionByName, parts)


@query(f"""WITH {ASKED}, {FOUND}, o AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score_original DESC, src, src_rank) AS rank FROM found WHERE src_rank <= 3 AND score_original >= {PROFILES['adversarial'].min_score} QUALIFY rank <= {PROFILES['adversarial'].limit}),
c AS (SELECT *, {_terms('low', statute_rules.COMPANY_TERMS)} AS company, {_terms('low', statute_rules.MUNICIPAL_TERMS)} AS municipal FROM o),
s AS (SELECT *, round(score_original + CASE WHEN company >= 2 THEN CASE src WHEN '{statute_rules.COMPANY_SOURCE}' THEN 0.08::DOUBLE WHEN '{statute_rules.CORE_SOURCE}' THEN -0.03::DOUBLE ELSE 0 END
      WHEN municipal >= 1 AND company = 0 THEN CASE WHEN src = '{statute_rules.CORE_SOURCE}' THEN 0.08::DOUBLE WHEN src IN {statute_rules.ACCOUNTING_SOURCES} THEN -0.05::DOUBLE ELSE 0 END ELSE 0 END, 6) AS score FROM c)
SELECT question_id, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, rank) AS INT) AS rank, src, CAST(id AS INT) AS id, score FROM s""")
def statute_context(spark: SparkSession, d: str) -> DataFrame:
    """The adversarial profile: the same hits of every statute, then the context of company and municipality."""
    p = PROFILES["adversarial"]
    order = Window.partitionBy("question_id").orderBy(F.desc("score"), "src", "src_rank")
    hits = _found(spark, d).filter((F.col("src_rank") <= 3) & (F.col("score") >= p.min_score)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.limit)
    r = statute_rules
    return search.context_boost(hits, asked(spark, d), r.COMPANY_TERMS, r.MUNICIPAL_TERMS, r.COMPANY_SOURCE, r.CORE_SOURCE, r.ACCOUNTING_SOURCES)


SECTIONS = STATUTE_BOOSTS.overlap_sections


def _moments(spark: SparkSession, d: str) -> DataFrame:
    """(question_id, rank, score, section_id, moment, anchors): nine sections a question, with the statute's anchors."""
    n = F.col("question_id")
    rows = asked(spark, d).select("question_id", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("rank"))
    rows = rows.select("question_id", "rank", F.round(F.lit(0.95) - F.col("rank") / 25, 6).alias("score"), _pick(SECTIONS, n + F.col("rank")).alias("section_id"), (F.pmod(n * F.col("rank"), F.lit(7)) + 1).cast("string").alias("moment"))
    of = spark.createDataFrame([(s, m, list(a)) for (s, m), a in statute_rules.MUNICIPAL_ANCHOR_TERMS.items()], "section string, moment string, anchors array<string>")
    return enrich.anchors(rows, of)


_ANCHORS_SQL = ", ".join(f"('{s}', '{m}', {_listed(a)})" for (s, m), a in statute_rules.MUNICIPAL_ANCHOR_TERMS.items())
MOMENTS = f"""anchor_rules AS (SELECT * FROM (VALUES {_ANCHORS_SQL}) v(section, moment, terms)),
moments AS (SELECT question_id, low, r AS rank, round(0.95::DOUBLE - r::DOUBLE / 25, 6) AS score, s[(question_id + r) % {len(SECTIONS)} + 1] AS section_id, CAST((question_id * r) % 7 + 1 AS VARCHAR) AS moment FROM asked, (SELECT {_listed(SECTIONS)} AS s), (SELECT unnest(range(1, 10)) AS r)),
anchored AS (SELECT m.*, list_concat(coalesce(e.terms, []), coalesce(f.terms, [])) AS anchors FROM moments m LEFT JOIN anchor_rules e ON e.section = section_id AND e.moment = m.moment LEFT JOIN anchor_rules f ON f.section = section_id AND f.moment = 'default')"""


@query(f"WITH {ASKED}, {MOMENTS} SELECT question_id, CAST(rank AS INT) AS rank, section_id, moment, array_to_string(anchors, '|') AS anchors FROM anchored")
def statute_anchors(spark: SparkSession, d: str) -> DataFrame:
    return _moments(spark, d).select("question_id", "rank", "section_id", "moment", F.array_join("anchors", "|").alias("anchors"))


def _change_sql() -> str:
    parts = [f"CASE WHEN ({_any('low', terms)}) AND section_id = '{of}'" + ("" if at is None else f" AND moment = '{at}'") + f" THEN {add}::DOUBLE ELSE 0 END" for terms, of, at, add in STATUTE_BOOSTS.boosts]
    parts += [f"CASE WHEN ({_any('low', terms)}) AND section_id = '{of}' THEN {add}::DOUBLE ELSE 0 END" for terms, of, add in STATUTE_BOOSTS.penalties]
    parts.append(f"CASE WHEN ({_any('low', STATUTE_BOOSTS.overlap_terms)}) AND section_id IN {SECTIONS} THEN least({STATUTE_BOOSTS.overlap_unit}::DOUBLE * overlap, {STATUTE_BOOSTS.overlap_most}::DOUBLE) ELSE 0 END")
    return " + ".join(parts)


@query(rf"""WITH {ASKED}, {MOMENTS}, w AS (SELECT *, regexp_extract_all(low, '[\p{{L}}\p{{N}}_]+') AS w FROM anchored),
t AS (SELECT *, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS t FROM w),
o AS (SELECT *, len(list_filter(anchors, lambda a: list_contains(t, a) OR len(list_filter(string_split(a, ' '), lambda x: NOT list_contains(t, x))) = 0)) AS overlap FROM t),
h AS (SELECT *, greatest(least({_change_sql()}, score * {STATUTE_BOOSTS.cap_share}::DOUBLE), -(score * {STATUTE_BOOSTS.cap_share}::DOUBLE)) AS applied FROM o),
n AS (SELECT question_id, section_id, moment, rank AS old, round(greatest(score + applied, 0), 4) AS score, round(applied, 4) AS boost_applied FROM h)
SELECT question_id, section_id, moment, score, boost_applied, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, old) AS INT) AS rank FROM n""")
def statute_boosts(spark: SparkSession, d: str) -> DataFrame:
    return rerank.boost(_moments(spark, d), asked(spark, d), STATUTE_BOOSTS).select("question_id", "section_id", "moment", "score", "boost_applied", "rank")


def _tag_sql(column: str, tags: dict[str, tuple[str, ...]]) -> str:
    return ", ".join(f"CASE WHEN contains({column}, '{k}') THEN {_listed(v)} ELSE [] END" for k, v in tags.items())


MUNICIPAL = enrich.tag_rules(statute_rules.MUNICIPAL_CHAPTER_TAGS, statute_rules.MUNICIPAL_KEYWORD_TAGS)


@query(f"WITH {ASKED} SELECT question_id, array_to_string(list_sort(list_distinct(flatten([{_tag_sql('low', MUNICIPAL)}]))), ',') AS tags FROM asked")
def statute_tags(spark: SparkSession, d: str) -> DataFrame:
    return asked(spark, d).select("question_id", F.array_join(enrich.keyword_tags(F.col("text"), MUNICIPAL), ",").alias("tags"))


NODES = tuple(dict.fromkeys(f"{p}{tail}" for p, _, _ in statute_rules.MAPPING_RULES for tail in ("", ":1", ":2"))) + ("hankintalaki_1397_2016:5",)


@query(f"""WITH {ASKED}, p AS (SELECT 'q' || question_id || ':' || (SELECT {_listed(NODES)})[question_id % {len(NODES)} + 1] AS law_node_id, r AS doc_node_id, r AS rank, round(1 - r::DOUBLE / 10, 6) AS score, CASE WHEN r % 2 = 0 THEN upper(text) ELSE '' END AS title, CASE WHEN r % 2 = 0 THEN 'muu' ELSE text END AS text FROM asked, (SELECT unnest(range(1, 6)) AS r)),
r AS ({" UNION ALL ".join(f"SELECT law_node_id, doc_node_id, '{kind}' AS edge_type, score, 'Rule match: {p} -> ' || CASE " + " ".join(f"WHEN contains(lower(title) || chr(10) || lower(text), '{s}') THEN '{s}'" for s in secs) + f" END AS context FROM p WHERE contains(law_node_id, '{p}')" for p, secs, kind in statute_rules.MAPPING_RULES)}),
k AS (SELECT * FROM r WHERE context IS NOT NULL)
SELECT * FROM k UNION ALL SELECT law_node_id, doc_node_id, 'EVIDENCED_BY', score, 'Semantic similarity match' FROM p WHERE rank <= 3 AND law_node_id NOT IN (SELECT law_node_id FROM k)""")
def statute_mapping(spark: SparkSession, d: str) -> DataFrame:
    return documents.mapping_edges(_pairs(spark, d), statute_rules.MAPPING_RULES).select("law_node_id", "doc_node_id", "edge_type", "score", "context")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("rank")
    rows = asked(spark, d).select("question_id", "text", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("rank"))
    node = F.concat(F.lit("q"), F.col("question_id").cast("string"), F.lit(":"), _pick(NODES, F.col("question_id")))
    return rows.select(node.alias("law_node_id"), r.alias("doc_node_id"), "rank", F.round(1 - r / 10, 6).alias("score"), F.when(r % 2 == 0, F.upper("text")).otherwise("").alias("title"), F.when(r % 2 == 0, "muu").otherwise(F.col("text")).alias("text"))


@query(SQL["statute_mapping"])
def statute_mapping_table(spark: SparkSession, d: str) -> DataFrame:
    """statute_mapping with the rules as a table."""
    rules_ = [(i, p, kind, j, sec) for i, (p, secs, kind) in enumerate(statute_rules.MAPPING_RULES) for j, sec in enumerate(secs)]
    table_ = spark.createDataFrame(rules_, "rule_no int, pattern string, edge_type string, place int, section string")
    return documents.mapping_edges_by_table(_pairs(spark, d), table_).select("law_node_id", "doc_node_id", "edge_type", "score", "context")


@query(f"SELECT question_id, rank, src, id, score FROM ({_profile_sql()}) WHERE profile = 'autofill'")
def statute_guards_table(spark: SparkSession, d: str) -> DataFrame:
    """The profile of autofill with its guards as a table."""
    questions, p = asked(spark, d), PROFILES["autofill"]
    guards = spark.createDataFrame(list(p.guards), "term string, src string, adjust double")
    near = search.within_budget(_found(spark, d), questions, STATUTES, p)
    return search.merge(near, questions, p, STATUTES.core, guards=guards).select("question_id", "rank", "src", "id", "score")
