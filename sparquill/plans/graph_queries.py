"""Catalog: citation graphs and report documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.operators import documents, graph
from sparquill.plans.catalog import GUIDED, corpus, hits_sql, query, questions, spread, table
from sparquill.plans.rerank_queries import TOP10_SQL, top10
from sparquill.plans.rules import DEFINITION_PHRASES, EXCEPTION_PHRASES, LANGUAGES, STATUTE_NUMBERS
from sparquill.sources import statutes

BODY_SQL = """CASE p_partkey % 5 WHEN 0 THEN 'Jollei ' || p_size || ' §:ssä toisin säädetä, noudatetaan ' || (p_size + 1) || ' §:n 2 momentissa olevaa.'
 WHEN 1 THEN 'Sovelletaan ' || p_size || ' luvun ' || (p_size % 9 + 1) || ' § ja ' || (p_size % 9 + 1) || ' §:n mukaan.' WHEN 2 THEN (p_size + 3) || ' §:n 1 mom. ja ' || (p_size + 3) || ' §:n 1 momentti sekä ' || p_size || ' §'
 WHEN 3 THEN 'Tässä laissa tarkoitetaan, osakeyhtiölain (624/2006) ja kirjanpitolaki' ELSE 'Ei viittauksia.' END"""


def _statutes(spark: SparkSession, d: str) -> DataFrame:
    """Neutral rows of the shape of a statute, one a part."""
    return table(spark, d, "part").select(
        F.concat_ws(":", F.concat(F.lit("law"), (F.col("p_partkey") % 3).cast("string")), F.lit("v1"), F.col("p_size").cast("string"), F.col("p_partkey").cast("string")).alias("node_id"),
        F.concat(F.lit("law"), (F.col("p_partkey") % 3).cast("string")).alias("law_id"), F.lit("v1").alias("version"), F.col("p_size").alias("section_num"), F.col("p_partkey").cast("string").alias("moment"), F.expr(BODY_SQL).alias("text"), "p_partkey",
    )


# The patterns of references within a statute.
_D = "(?:n|ssä|ssa|ään|stä|sta|lta|lle|lla)"
_P1, _P2, _P3, _P4 = rf"(?i)(\d+)\s*§:?{_D}?\s+(\d+)\s*(?:momentti|mom\.?|momentissa|momentti(?:in|a|ssa))", rf"(?i)(\d+)\s*§:?{_D}", r"(?i)(\d+)\s*(?:luvun|luku)\s+(\d+)\s*§", r"(\d+)\s*§"


def _pass(step: int, pattern: str, section: int, moment: int | None) -> str:
    got = f"unnest(regexp_extract_all(text, '{pattern}', {{}}))"
    return f"SELECT p_partkey, {step} AS step, generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) AS pos, {got.format(section)} AS section, {got.format(moment) if moment else 'NULL::VARCHAR'} AS moment, {got.format(0)} AS context FROM b"


@query(f"""WITH b AS (SELECT p_partkey, {BODY_SQL} AS text FROM part),
m AS ({_pass(1, _P1, 1, 2)} UNION ALL {_pass(2, _P2, 1, None)} UNION ALL {_pass(3, _P3, 2, None)} UNION ALL {_pass(4, _P4, 1, None)}),
n AS (SELECT *, row_number() OVER (PARTITION BY p_partkey, section, moment ORDER BY step, pos) AS nth, count(*) OVER (PARTITION BY p_partkey, section ORDER BY step, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS met FROM m)
SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY step, pos) AS INT) AS ref_no, CAST(section AS INT) AS section, moment, context FROM n WHERE CASE WHEN moment IS NULL THEN met = 0 ELSE nth = 1 END""")
def section_references(spark: SparkSession, d: str) -> DataFrame:
    return graph.section_references(_statutes(spark, d), "p_partkey")


_REFS_SQL = f"""m AS ({_pass(1, _P1, 1, 2)} UNION ALL {_pass(2, _P2, 1, None)} UNION ALL {_pass(3, _P3, 2, None)} UNION ALL {_pass(4, _P4, 1, None)}),
n AS (SELECT *, row_number() OVER (PARTITION BY p_partkey, section, moment ORDER BY step, pos) AS nth, count(*) OVER (PARTITION BY p_partkey, section ORDER BY step, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS met FROM m),
refs AS (SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY step, pos) AS INT) AS ref_no, CAST(section AS INT) AS section, moment, context FROM n WHERE CASE WHEN moment IS NULL THEN met = 0 ELSE nth = 1 END)"""
# Fixed value: the pattern of references to other statutes.
_EXTERNAL = r"(?i)([\p{L}\p{N}_]+lain?|asetuksen?)\s*\((\d+/\d+)\)"


def _any_sql(column: str, terms: tuple[str, ...]) -> str:
    return " OR ".join(f"contains({column}, '{t}')" for t in terms)


@query(f"""WITH b AS (SELECT p_partkey, 'law' || (p_partkey % 3) || ':v1:' || p_size || ':' || p_partkey AS node_id, 'law' || (p_partkey % 3) AS law_id, p_size, CAST(p_partkey AS VARCHAR) AS own_moment, {BODY_SQL} AS text FROM part),
{_REFS_SQL},
r AS (SELECT b.*, ref_no, section, moment, context, instr(text, context) AS p FROM refs JOIN b USING (p_partkey) WHERE NOT (section = p_size AND (moment IS NULL OR moment = own_moment))),
i AS (SELECT r.node_id AS source, coalesce(t.node_id, CASE WHEN r.moment IS NULL THEN r.law_id || ':v1:' || section || ':*' ELSE r.law_id || ':*:' || section || ':' || r.moment END) AS target,
             CASE WHEN {_any_sql("lower(substr(r.text, greatest(1, p - 100), p - greatest(1, p - 100)))", EXCEPTION_PHRASES)} THEN 'EXCEPTS' ELSE 'REFERS_TO' END AS edge_type, context, 1 AS step, ref_no AS pos
      FROM r LEFT JOIN b t ON t.law_id = r.law_id AND t.p_size = r.section AND t.own_moment = r.moment),
x AS (SELECT node_id, unnest(regexp_extract_all(text, '{_EXTERNAL}', 2)) AS number, unnest(regexp_extract_all(text, '{_EXTERNAL}')) AS context, generate_subscripts(regexp_extract_all(text, '{_EXTERNAL}'), 1) - 1 AS pos FROM b),
w AS (SELECT node_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS word, generate_subscripts(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'), 1) AS pos FROM b),
s AS (SELECT node_id, number, arg_min(word, pos) AS context FROM w JOIN (VALUES {", ".join(f"('{k}', '{v}')" for k, v in STATUTE_NUMBERS.items())}) v(word, number) USING (word) WHERE (node_id, number) NOT IN (SELECT (node_id, number) FROM x) GROUP BY node_id, number),
e AS (SELECT * FROM i UNION ALL SELECT node_id, 'external:' || number, 'REFERS_TO', context, 2, pos FROM x UNION ALL SELECT node_id, 'external:' || number, 'REFERS_TO', context, 3, 0 FROM s
      UNION ALL SELECT node_id, 'definition:' || node_id, 'DEFINES', '', 4, 0 FROM b WHERE {_any_sql("lower(text)", DEFINITION_PHRASES)})
SELECT source, target, edge_type, context, CAST(row_number() OVER (PARTITION BY source ORDER BY step, pos, target) AS INT) AS edge_ord FROM e""")
def reference_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.reference_edges(_statutes(spark, d))


PHRASES = ("the", " on ", "der ")


@query("""WITH x AS (SELECT doc_id, lower(text) AS low, text, regexp_extract(text, '[0-9]+') AS context FROM documents),
y AS (SELECT *, instr(text, context) AS p FROM x), z AS (SELECT *, CASE WHEN context <> '' AND p > 0 THEN lower(substr(text, greatest(1, p - 100), p - greatest(1, p - 100))) ELSE '' END AS head FROM y)
SELECT doc_id, context, contains(head, 'the') OR contains(head, ' on ') OR contains(head, 'der ') AS excepts, contains(low, 'the') OR contains(low, ' on ') OR contains(low, 'der ') AS defines FROM z""")
def exception_context(spark: SparkSession, d: str) -> DataFrame:
    found = F.regexp_extract("text", "[0-9]+", 0)
    docs = table(spark, d, "documents").withColumn("context", found)
    return docs.select("doc_id", "context", (graph.is_exception(F.col("text"), F.col("context"), PHRASES) & (F.col("context") != "")).alias("excepts"), graph.is_definition(F.col("text"), PHRASES).alias("defines"))


HIER_SQL = """h AS (SELECT DISTINCT 'law:' || c_nationkey AS source, 'section:' || c_nationkey || ':' || (c_custkey % 50) AS target, 'HAS_SECTION' AS edge_type FROM customer
UNION SELECT DISTINCT 'section:' || c_nationkey || ':' || (c_custkey % 50), CAST(c_custkey AS VARCHAR), 'HAS_MOMENT' FROM customer)"""


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("law_key"), (F.col("c_custkey") % 50).alias("section_num"), F.col("c_custkey").alias("node_id"))


@query(f"WITH {HIER_SQL} SELECT * FROM h")
def hierarchy_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.hierarchy_edges(_customers(spark, d))


@query(f"WITH {HIER_SQL} SELECT edge_type, starts_with(target, 'external:') AS external, count(*) AS n FROM h GROUP BY ALL")
def edge_stats(spark: SparkSession, d: str) -> DataFrame:
    return graph.edge_stats(graph.hierarchy_edges(_customers(spark, d)))


@query('SELECT a.c_custkey AS "primary", b.c_custkey AS node_id FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_custkey % 50 = b.c_custkey % 50')
def sibling_expand(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "customer").select(F.col("c_custkey").alias("node_id"))
    return graph.siblings(asked, _customers(spark, d))


PLACES_SQL = """e AS (SELECT 'r' || n_regionkey AS a, 'n' || n_nationkey AS b FROM nation UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e)"""


@query(f"""WITH RECURSIVE {PLACES_SQL},
w AS (SELECT 'r' || r_regionkey AS start, 'r' || r_regionkey AS node_id, 0 AS hop FROM region UNION SELECT w.start, u.b, w.hop + 1 FROM w JOIN u ON u.a = w.node_id WHERE w.hop < 2)
SELECT start, node_id, CAST(min(hop) AS INT) AS hop FROM w GROUP BY start, node_id""")
def bounded_bfs(spark: SparkSession, d: str) -> DataFrame:
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    edges = table(spark, d, "nation").select(name("r", "n_regionkey").alias("source"), name("n", "n_nationkey").alias("target"))
    edges = edges.union(table(spark, d, "supplier").select(name("n", "s_nationkey"), name("s", "s_suppkey")))
    return graph.neighbors(table(spark, d, "region").select(name("r", "r_regionkey").alias("node_id")), edges, 2)


def _parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    nodes = table(spark, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node_id"), (F.col("p_partkey") % 7).alias("law_key"), (F.col("p_partkey") % 50).cast("int").alias("section_num"))
    kinds = F.when(F.col("l_linenumber") == 1, "EXCEPTS").when(F.col("l_linenumber") == 2, "DEFINES").otherwise("REFERS_TO")
    edges = table(spark, d, "lineitem").select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("source"), F.concat(F.lit("p"), (F.col("l_suppkey") * 13 + F.col("l_linenumber")).cast("string")).alias("target"), kinds.alias("edge_type"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("edge_ord"))
    primaries = table(spark, d, "part").filter("p_partkey % 100 = 0").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("primary"), F.lit(0.7).alias("score"))
    return nodes, edges, primaries


def _walk_sql(primaries: str) -> str:
    """CTEs f1 and f2 (primary_id, node_id, via, hop, queue): what one and two hops reach, from nodes, edges and a select of primaries."""
    return f"""
walk AS (SELECT source AS node_id, target AS next, edge_type AS via, 0 AS back, edge_ord FROM edges UNION ALL SELECT target, source, 'EXCEPTS', 1, edge_ord FROM edges WHERE edge_type = 'EXCEPTS'),
f0 AS (SELECT a.node_id AS primary_id, b.node_id, row_number() OVER (PARTITION BY a.node_id ORDER BY b.node_id <> a.node_id, b.node_id) AS queue
       FROM nodes a JOIN nodes b USING (law_key, section_num) WHERE a.node_id IN ({primaries})),
s1 AS (SELECT f0.primary_id, walk.*, f0.queue FROM f0 JOIN walk USING (node_id) WHERE (f0.primary_id, walk.next) NOT IN (SELECT (primary_id, node_id) FROM f0)),
b1 AS (SELECT * FROM s1 QUALIFY row_number() OVER (PARTITION BY primary_id, next ORDER BY queue, back, edge_ord, node_id) = 1),
f1 AS (SELECT primary_id, next AS node_id, via, 1 AS hop, row_number() OVER (PARTITION BY primary_id ORDER BY queue, back, edge_ord, next) AS queue FROM b1),
seen AS (SELECT primary_id, node_id FROM f0 UNION ALL SELECT primary_id, node_id FROM f1),
s2 AS (SELECT f1.primary_id, walk.*, f1.queue FROM f1 JOIN walk USING (node_id) WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.primary_id = f1.primary_id AND seen.node_id = walk.next)),
b2 AS (SELECT * FROM s2 QUALIFY row_number() OVER (PARTITION BY primary_id, next ORDER BY queue, back, edge_ord, node_id) = 1),
f2 AS (SELECT primary_id, next AS node_id, via, 2 AS hop, row_number() OVER (PARTITION BY primary_id ORDER BY queue, back, edge_ord, next) AS queue FROM b2)"""


WALK_SQL = f"""nodes AS (SELECT 'p' || p_partkey AS node_id, p_partkey % 7 AS law_key, p_partkey % 50 AS section_num FROM part),
edges AS (SELECT 'p' || l_partkey AS source, 'p' || (l_suppkey * 13 + l_linenumber) AS target, CASE l_linenumber WHEN 1 THEN 'EXCEPTS' WHEN 2 THEN 'DEFINES' ELSE 'REFERS_TO' END AS edge_type, l_orderkey * 10 + l_linenumber AS edge_ord FROM lineitem),
{_walk_sql("SELECT 'p' || p_partkey FROM part WHERE p_partkey % 100 = 0")},
expanded AS (SELECT *, round(greatest(0, 0.7::DOUBLE - 0.05::DOUBLE * hop + 0.01::DOUBLE * CASE via WHEN 'EXCEPTS' THEN 3 WHEN 'REFERS_TO' THEN 2 ELSE 1 END), 6) AS support_score FROM (SELECT * FROM f1 UNION ALL SELECT * FROM f2))"""


def support_score(score: Column, hop: Column, relation: Column) -> Column:
    return F.round(graph.neighbor_score(score, hop, relation), 6)


@query(f'WITH {WALK_SQL} SELECT primary_id AS "primary", node_id, hop, via AS relation, support_score FROM expanded')
def neighbor_score(spark: SparkSession, d: str) -> DataFrame:
    nodes, edges, primaries = _parts(spark, d)
    found = graph.expand(primaries, nodes, edges, value=support_score)
    return found.select("primary", "node_id", "hop", "relation", F.col("score").alias("support_score"))


@query(f"""WITH {WALK_SQL}, r AS (SELECT e.* FROM expanded e JOIN nodes USING (node_id)),
k AS (SELECT * FROM r QUALIFY via <> 'EXCEPTS' OR row_number() OVER (PARTITION BY primary_id, via = 'EXCEPTS' ORDER BY hop, queue) = 1)
SELECT primary_id AS "primary", node_id, hop, via AS relation, support_score, CAST(row_number() OVER (PARTITION BY primary_id ORDER BY CASE via WHEN 'EXCEPTS' THEN 3 WHEN 'REFERS_TO' THEN 2 ELSE 1 END DESC, support_score DESC, hop, queue) AS INT) AS place
FROM k QUALIFY place <= 5""")
def support_selection(spark: SparkSession, d: str) -> DataFrame:
    nodes, edges, primaries = _parts(spark, d)
    return graph.selected(primaries, nodes, edges)


def _talks(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as documents: a page a turn, with a section of the speaker's role and two levels below it."""
    kind = "title:string,level:int,paragraphs:array<string>,tables:array<struct<title:string,rows:array<struct<cells:array<string>>>>>"
    none, text = F.array().cast("array<string>"), F.array("text")
    tables = F.array().cast("array<struct<title:string,rows:array<struct<cells:array<string>>>>>")
    part = lambda title, level, paragraphs, kids: F.struct(title.alias("title"), F.lit(level).alias("level"), paragraphs.alias("paragraphs"), tables.alias("tables"), kids.alias("subsections"))
    deep = part(F.lit("Deep Part"), 3, text, F.array().cast(f"array<struct<{kind}>>"))
    section = part(F.col("role"), 1, text, F.array(part(F.lit("sub"), 2, none, F.array(deep))))
    pages = table(spark, d, "conversations").select("conv_id", F.struct(F.col("turn").cast("int").alias("page_num"), F.array(section).alias("sections")).alias("page"))
    docs = pages.groupBy("conv_id").agg(F.sort_array(F.collect_list("page")).alias("pages"))
    return docs.select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("city"), F.lit(1).alias("year"), F.lit("talk").alias("title"), "pages", F.array().cast("array<struct<name:string,value:double,unit:string,page:int>>").alias("metrics"))


TALK_SQL = r"""t AS (SELECT 'c' || conv_id || ':1' AS root, CAST(turn AS INT) AS page, role, coalesce(text, '') AS text, lower(replace(role, ' ', '_')) AS slug, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS pos FROM conversations),
s AS (SELECT root, page, slug AS path, role AS title, root || ':PAGE:' || page AS parent_id, text FROM t UNION ALL SELECT root, page, slug || ':sub', 'sub', root || ':SECTION:' || slug, '' FROM t
      UNION ALL SELECT root, page, slug || ':sub:deep_part', 'Deep Part', root || ':SECTION:' || slug || ':sub', text FROM t)"""
LONG_SQL = r"length(regexp_replace(text, '^\s+|\s+$', '', 'g')) > 50"


@query(f"""WITH {TALK_SQL} SELECT DISTINCT root || ':DOC:root' AS node_id, 'DOC' AS node_type, 'talk' AS title, NULL::INT AS page_num, NULL::VARCHAR AS parent_id, md5('') AS text_md5 FROM t
UNION ALL SELECT root || ':PAGE:' || page, 'PAGE', 'Sivu ' || page, page, root || ':DOC:root', md5('') FROM t UNION ALL SELECT root || ':SECTION:' || path, 'SECTION', title, page, parent_id, md5(text) FROM s
UNION ALL SELECT root || ':PARA:' || path || ':p0', 'PARA', '', page, root || ':SECTION:' || path, md5(text) FROM s WHERE {LONG_SQL}""")
def doc_flatten(spark: SparkSession, d: str) -> DataFrame:
    return documents.document_graph(_talks(spark, d))[0].select("node_id", "node_type", "title", "page_num", "parent_id", F.md5("text").alias("text_md5"))


@query(f"""WITH {TALK_SQL} SELECT root || ':DOC:root' AS source, root || ':PAGE:' || page AS target, 'HAS_PAGE' AS edge_type, 'Page ' || page AS context FROM t
UNION ALL SELECT parent_id, root || ':SECTION:' || path, 'HAS_SECTION', title FROM s UNION ALL SELECT root || ':SECTION:' || path, root || ':PARA:' || path || ':p0', 'HAS_PARA', 'Paragraph 0' FROM s WHERE {LONG_SQL}
UNION ALL SELECT a.root || ':PAGE:' || a.page, b.root || ':PAGE:' || b.page, 'NEXT', 'Sequential pages' FROM t a JOIN t b ON a.root = b.root AND b.pos = a.pos + 1""")
def doc_edges(spark: SparkSession, d: str) -> DataFrame:
    return documents.document_graph(_talks(spark, d))[1]


@query("""SELECT CAST(n_regionkey AS INT) AS page, r_name AS section, 'nations' AS table_title, n_name AS row_name, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS INT) AS row_idx,
n_nationkey * 1000 + 0.5::DOUBLE AS value FROM nation JOIN region ON n_regionkey = r_regionkey""")
def table_rows(spark: SparkSession, d: str) -> DataFrame:
    row = F.struct(F.array("n_name", F.concat(F.col("n_nationkey").cast("string"), F.lit(" 000,5")), F.lit("n/a")).alias("cells"))
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    tables = nations.groupBy("n_regionkey", "r_name").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    section = F.struct(F.col("r_name").alias("title"), F.array(F.struct(F.lit("nations").alias("title"), F.col("rows"))).alias("tables"))
    docs = tables.select(F.array(F.struct(F.col("n_regionkey").cast("int").alias("page_num"), F.array(section).alias("sections"))).alias("pages"))
    return documents.table_rows(docs).select("page", "section", "table_title", "row_name", "row_idx", documents.numeric(F.col("value_2023")).alias("value"))


ASKED_TABLES = ("brass small part", "steel ivory steel", "promo nickel", "what is standard tin")


@query("WITH q AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{t}')" for i, t in enumerate(ASKED_TABLES)) + r""") v(question_id, text)),
w AS (SELECT question_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM q),
s AS (SELECT question_id, p_partkey, sum(2 * CAST(contains(lower(p_brand), word) AS INT) + CAST(contains(lower(p_type), word) AS INT)) AS points FROM w, part GROUP BY ALL)
SELECT CAST(question_id AS INT) AS question_id, p_partkey, CAST(points AS INT) AS points, CAST(row_number() OVER (PARTITION BY question_id ORDER BY points DESC, p_partkey) AS INT) AS rank FROM s WHERE points > 0 QUALIFY rank <= 5""")
def table_search(spark: SparkSession, d: str) -> DataFrame:
    asked = spark.createDataFrame(list(enumerate(ASKED_TABLES)), "question_id int, text string")
    rows = table(spark, d, "part").select(F.col("p_brand").alias("row_name"), F.col("p_type").alias("table_title"), "p_partkey")
    return documents.search_tables(asked, rows, order=("p_partkey",)).select("question_id", "p_partkey", "points", "rank")


SIGNALS = ("hein", "ouer", "ración", "2024")


@query("SELECT item_id, CASE " + " ".join(f"WHEN contains(lower(text), '{s}') THEN 'Signal: {s}'" for s in SIGNALS) + " WHEN contains(lower(text), 'the') AND (contains(lower(text), 'sch') OR contains(lower(text), 'eau')) THEN 'Cross-city comparison' END AS reason FROM benchmark")
def abstain_v11(spark: SparkSession, d: str) -> DataFrame:
    reason = documents.abstain_signal(F.col("text"), SIGNALS, "the", ("sch", "eau"))
    return table(spark, d, "benchmark").select("item_id", reason.alias("reason"))


STRONG, INTERPRET = ("heinou", "ouera", "llña"), ("that.*then", "eau.*oui")


@query(rf"""WITH {TOP10_SQL}, b AS (SELECT question_id, max(score) AS best FROM top GROUP BY question_id), q AS (SELECT item_id, lower(text) AS low, b.best FROM benchmark LEFT JOIN b ON b.question_id = item_id)
SELECT item_id, CASE {' '.join(f"WHEN contains(low, '{documents.signal_root(s)}') OR contains(low, '{s}') THEN 'Strong signal: ''{s}'''" for s in STRONG)}
{' '.join(f"WHEN regexp_matches(low, '{p}') AND coalesce(best, 0) < 0.35 THEN 'Interpretation needed: ''{p}'''" for p in INTERPRET)}
WHEN regexp_matches(low, '\b202[4-9]\b|\b203\d\b') THEN 'Future/missing year' WHEN best IS NULL THEN 'No relevant data found' END AS reason FROM q""")
def abstain_v10(spark: SparkSession, d: str) -> DataFrame:
    best = top10(spark, d).groupBy("question_id").agg(F.max("score").alias("best"))
    rows = table(spark, d, "benchmark").join(best, F.col("item_id") == F.col("question_id"), "left")
    reason = documents.abstain_reason(F.col("text"), F.col("best"), F.col("best").isNotNull(), STRONG, INTERPRET, sure=0.35)
    return rows.select("item_id", reason.alias("reason"))


MAPS = (("law:1", ("the ", "eau"), "REQUIRES"), ("law:2", ("sch", "ción"), "EVIDENCED_BY_RULE"), (":3", ("zzz",), "NEVER"), ("law", ("hein",), "EXPLAINS"))


def _held(secs: tuple[str, ...]) -> str:
    return "CASE " + " ".join(f"WHEN contains(src || chr(10) || lower(body), '{s}') THEN '{s}'" for s in secs) + " END"


@query(f"""WITH {TOP10_SQL}, p AS (SELECT 'law:' || question_id AS law_node_id, id AS doc_node_id, rank, score, src, body FROM top WHERE rank <= 5),
r AS ({' UNION ALL '.join(f"SELECT law_node_id, doc_node_id, '{kind}' AS edge_type, score, {_held(secs)} AS sec, 'Rule match: {p} -> ' AS lead FROM p WHERE contains(law_node_id, '{p}')" for p, secs, kind in MAPS)}),
k AS (SELECT law_node_id, doc_node_id, edge_type, score, lead || sec AS context FROM r WHERE sec IS NOT NULL)
SELECT * FROM k UNION ALL SELECT law_node_id, doc_node_id, 'EVIDENCED_BY', score, 'Semantic similarity match' FROM p WHERE rank <= 3 AND law_node_id NOT IN (SELECT law_node_id FROM k)""")
def mapping_edges(spark: SparkSession, d: str) -> DataFrame:
    pairs = top10(spark, d).filter("rank <= 5").select(F.concat(F.lit("law:"), F.col("question_id").cast("string")).alias("law_node_id"), F.col("id").alias("doc_node_id"), "rank", "score", F.col("src").alias("title"), F.col("body").alias("text"))
    return documents.mapping_edges(pairs, MAPS).select("law_node_id", "doc_node_id", "edge_type", "score", "context")


SYNONYMS = (("the", ("a", "an", "one")), ("on", ("upon", "at")), ("eau", ("aqua",)), ("sch", ("sh", "s")))


@query("WITH m AS (SELECT item_id, lower(text) AS own, unnest([" + ", ".join(f"regexp_replace(text, '{t}', '{s}', 'gi')" for t, syns in SYNONYMS for s in syns[:2]) + "]) AS new, unnest(range(" + str(sum(len(s[:2]) for _, s in SYNONYMS)) + """)) AS pos FROM benchmark),
f AS (SELECT * FROM m WHERE lower(new) <> own QUALIFY row_number() OVER (PARTITION BY item_id, lower(new) ORDER BY pos) = 1)
SELECT item_id AS question_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY pos) AS INT) AS paraphrase_no, new AS text FROM f QUALIFY paraphrase_no <= 3""")
def paraphrases(spark: SparkSession, d: str) -> DataFrame:
    return documents.paraphrases(table(spark, d, "benchmark").select(F.col("item_id").alias("question_id"), "text"), SYNONYMS)


def statute_files(spark: SparkSession, d: str) -> DataFrame:
    """(path, xml): a statute a part: a chapter, a section with a suffix, three subsections of which the second is empty."""
    number, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    xml = F.concat(
        F.lit('<?xml version="1.0"?><akomaNtoso xmlns="http://example.org/akn"><act><meta><FRBRversionNumber value="fin@'), number, F.lit('"/><dateEntryIntoForce date="2020-01-01"/></meta><body><chapter><num>'), size,
        F.lit(" luku</num><heading>Yleiset</heading><section><num>"), size, F.lit(" a §</num><heading>"), F.col("p_type"), F.lit("</heading><subsection><intro>Osa "), number, F.lit("</intro><paragraph><num>1)</num><content>"), F.col("p_brand"),
        F.lit("</content></paragraph><paragraph><content>toinen</content></paragraph></subsection><subsection/><subsection><content>Kolmas "), number, F.lit("</content></subsection></section></chapter></body></act></akomaNtoso>"),
    )
    return spread(table(spark, d, "part"), "p_partkey").select(F.concat(number, F.lit(".xml")).alias("path"), xml.alias("xml"))


@query("""SELECT '1/2020:fin@' || p_partkey || ':' || p_size || 'l:' || p_size || 'a:' || m AS node_id, p_size || 'a' AS section_id, p_size AS section_num, m AS moment,
CASE m WHEN '1' THEN 'Osa ' || p_partkey || ' 1) ' || p_brand || ' toinen' ELSE 'Kolmas ' || p_partkey END AS text, array_to_string(list_sort([lower(p_type)] || CASE m WHEN '3' THEN ['third'] ELSE [] END), ',') AS tags FROM part, (VALUES ('1'), ('3')) v(m)""")
def xml_ingest(spark: SparkSession, d: str) -> DataFrame:
    """A statute file a part."""
    rows = statute_files(spark, d)
    found = statutes.unique_ids(statutes.moments(rows, "Laki", "1/2020", "laki_1_2020", {"kolmas": ("third",)}))
    return found.select("node_id", "section_id", "section_num", "moment", "text", F.array_join("tags", ",").alias("tags"))


def _shown(column: str, length: int) -> str:
    return f"CASE WHEN length({column}) > {length} THEN substr({column}, 1, {length}) || '...' ELSE {column} END"


@query(f"""WITH {hits_sql(LANGUAGES, GUIDED).replace("ORDER BY score_original DESC, id)", "ORDER BY score_original DESC, CAST(id AS VARCHAR))")},
first AS (SELECT question_id, CAST(id AS VARCHAR) AS primary_id, score FROM merged WHERE rank = 1),
nodes AS (SELECT CAST(doc_id AS VARCHAR) AS node_id, source AS law_key, doc_id % 97 AS section_num, lang, text FROM documents),
edges AS (SELECT CAST(page_id AS VARCHAR) AS source, CAST(page_id * 3 % 997 AS VARCHAR) AS target, CASE WHEN page_id % 4 = 0 THEN 'EXCEPTS' ELSE 'REFERS_TO' END AS edge_type, page_id AS edge_ord FROM pages),
{_walk_sql("SELECT primary_id FROM first")},
r AS (SELECT question_id, e.*, round(greatest(0, first.score - 0.05::DOUBLE * hop + 0.01::DOUBLE * CASE via WHEN 'EXCEPTS' THEN 3 ELSE 2 END), 6) AS support_score FROM first JOIN (SELECT * FROM f1 UNION ALL SELECT * FROM f2) e USING (primary_id) JOIN nodes USING (node_id)),
k AS (SELECT * FROM r QUALIFY via <> 'EXCEPTS' OR row_number() OVER (PARTITION BY question_id, via = 'EXCEPTS' ORDER BY hop, queue) = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY via = 'EXCEPTS' DESC, support_score DESC, hop, queue) AS place FROM k QUALIFY place <= 5),
l AS (SELECT question_id, string_agg('- [' || via || '] ' || section_num || ' § ' || lang || ': ' || {_shown("text", 150)}, chr(10) ORDER BY place) AS body FROM p JOIN nodes USING (node_id) GROUP BY question_id)
SELECT question_id, '**' || section_num || ' § ' || lang || '**' || chr(10) || {_shown("text", 300)} || CASE WHEN body IS NULL THEN '' ELSE chr(10) || chr(10) || body END AS answer
FROM first JOIN nodes ON node_id = primary_id LEFT JOIN l USING (question_id)""")
def guided_answers(spark: SparkSession, d: str) -> DataFrame:
    """Questions over the language corpus, expanded over links between documents of one source."""
    from sparquill.operators import guided

    docs = table(spark, d, "documents").select(F.col("doc_id").alias("node_id"), F.col("source").alias("law_key"), (F.col("doc_id") % 97).cast("int").alias("section_num"), F.col("lang").alias("section_title"), "text")
    pages = table(spark, d, "pages").select(F.col("page_id").alias("source"), (F.col("page_id") * 3 % 997).alias("target"), F.when(F.col("page_id") % 4 == 0, "EXCEPTS").otherwise("REFERS_TO").alias("edge_type"), F.col("page_id").alias("edge_ord"))
    nodes = docs.withColumn("node_id", F.col("node_id").cast("string"))
    edges = pages.withColumn("source", F.col("source").cast("string")).withColumn("target", F.col("target").cast("string"))
    rows = corpus(spark, d).withColumn("id", F.col("id").cast("string"))
    hits, support, _ = guided.guided(questions(spark, d), rows, nodes, edges, LANGUAGES, GUIDED)
    return guided.answers(hits, support, nodes)
