"""Catalog: sources and sinks by round trips, rule loading, look-ups and the cases of the other question sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparquill.operators import documents, enrich, evaluation, graph, routing, search
from sparquill.operators.timing import Phases
from sparquill.plans.catalog import ASKED, CORPUS, corpus, diverse_sql, hits_sql, query, questions, route_sql, spread, table
from sparquill.plans.evaluation_queries import HITS_SQL, STRICT_SQL, _hits, _strict, gates_sql, measured
from sparquill.plans.catalog import SQL
from sparquill.plans.graph_queries import _customers, _talks, statute_files
from sparquill.plans.rerank_queries import TAGS, TOP10_SQL, top10
from sparquill.plans.rules import GATES_DOCUMENT, GATES_GRAPH, LANGUAGE_PROFILE, LANGUAGES
from sparquill.sources import files, sinks, statutes
from sparquill.staging import fresh_path
from sparquill.streaming import ingest


@query("SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents")
def json_lines_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    docs = table(spark, d, "documents")
    files.write_json_lines(docs, path)
    return files.json_lines(spark, path, "doc_id long, lang string, source string, text string", strict=True).select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@query("SELECT lang AS law_key, count(*) AS n, CAST(sum(vec_id) AS BIGINT) AS ids, round(sum(embedding[1]::DOUBLE), 4) AS first_sum FROM embeddings JOIN documents ON doc_id = vec_id WHERE lang IN ('en', 'de') GROUP BY lang")
def vector_table(spark: SparkSession, d: str) -> DataFrame:
    """Written with a folder a source, two sources read back."""
    path = fresh_path(spark, "vectors")
    rows = table(spark, d, "embeddings").join(table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), F.col("lang").alias("law_key")), "vec_id")
    files.write_vectors(rows, path, id_col="vec_id", files=2)
    back = files.read_vectors(spark, path, ["en", "de", "none"])
    return back.groupBy("law_key").agg(F.count("*").alias("n"), F.sum("vec_id").alias("ids"), F.round(F.sum(F.get("embedding", F.lit(0)).cast("double")), 4).alias("first_sum"))


@query("""SELECT 'node' AS kind, 'MOMENT' AS type, count(*) AS n FROM customer UNION ALL SELECT 'edge', 'HAS_SECTION', count(*) FROM (SELECT DISTINCT c_nationkey, c_custkey % 50 FROM customer) UNION ALL SELECT 'edge', 'HAS_MOMENT', count(*) FROM customer""")
def graph_files(spark: SparkSession, d: str) -> DataFrame:
    nodes = _customers(spark, d)
    return files.write_graph(nodes.withColumn("node_type", F.lit("MOMENT")), graph.hierarchy_edges(nodes), fresh_path(spark, "graph"))


LOADED = LANGUAGES.loaded({"en": ("that", "est"), "fr": ("eau", "vous", "ment")})


@query(f"WITH {ASKED}, {route_sql(LOADED)} SELECT question_id, src, round(weight, 6) AS weight, route_pos FROM weights")
def loaded_router(spark: SparkSession, d: str) -> DataFrame:
    """Keyword lists that were read replace those of their sources."""
    return routing.route(questions(spark, d), LOADED).withColumn("weight", F.round("weight", 6))


OWN_TAGS = {"the": ("own",), "zzz": ("never",), "her": ("pronoun", "own")}
MERGED = enrich.merged_rules(TAGS, OWN_TAGS)


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(flatten([" + ", ".join(f"CASE WHEN contains(lower(text), '{k}') THEN {list(v)} ELSE [] END" for k, v in MERGED.items()) + "]))), ',') AS tags FROM documents")
def merged_tags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.array_join(enrich.keyword_tags(F.col("text"), MERGED), ",").alias("tags"))


@query("""WITH n AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'PARA' WHEN 1 THEN 'ROW' WHEN 2 THEN 'METRIC' ELSE 'DOC' END AS kind, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS title, p_type || ' ' || p_partkey || ' ' || p_type AS text FROM part)
SELECT p_partkey, kind AS node_type, concat_ws(chr(10), nullif(title, ''), text, CASE WHEN kind = 'ROW' THEN p_partkey || ' | x' END, CASE WHEN kind = 'METRIC' THEN 'Arvo: ' || (p_partkey + 0.5)::DOUBLE || ' EUR' END) AS body
FROM n WHERE kind <> 'DOC' AND length(regexp_replace(title || ' ' || text, '^\\s+|\\s+$', '', 'g')) >= 20""")
def index_texts(spark: SparkSession, d: str) -> DataFrame:
    """What is indexed of a report's nodes, and the text that is embedded."""
    k = F.col("p_partkey")
    kind = F.when(k % 4 == 0, "PARA").when(k % 4 == 1, "ROW").when(k % 4 == 2, "METRIC").otherwise("DOC")
    nodes = table(spark, d, "part").select("p_partkey", kind.alias("node_type"), F.when(k % 3 == 0, "").otherwise(F.col("p_brand")).alias("title"), F.concat_ws(" ", "p_type", k.cast("string"), "p_type").alias("text"))
    kept = nodes.filter(enrich.indexable(F.col("node_type"), F.col("title"), F.col("text")))
    body = enrich.document_text(F.col("node_type"), F.col("title"), F.col("text"), F.array(k.cast("string"), F.lit("x")), (k + 0.5).cast("double"), F.lit("EUR"))
    return kept.select("p_partkey", "node_type", body.alias("body"))


@query("SELECT c_custkey::VARCHAR AS node_id, c_nationkey AS law_key FROM customer WHERE contains(c_custkey::VARCHAR, '77') ORDER BY node_id LIMIT 10")
def node_lookup(spark: SparkSession, d: str) -> DataFrame:
    nodes = _customers(spark, d).withColumn("node_id", F.col("node_id").cast("string"))
    return graph.lookup(nodes, "77").select("node_id", "law_key")


@query("""SELECT n.n_nationkey::VARCHAR AS target, s_suppkey::VARCHAR AS source, CASE WHEN s_suppkey % 3 = 0 THEN 'EXCEPTS' ELSE 'REFERS_TO' END AS edge_type FROM supplier JOIN nation n ON n.n_nationkey = s_nationkey
WHERE n.n_regionkey = 2 AND contains(n.n_regionkey::VARCHAR, '2') AND s_suppkey % 5 <> 0 ORDER BY target, source, edge_type LIMIT 20""")
def section_incoming(spark: SparkSession, d: str) -> DataFrame:
    """The first references and exceptions to a section's nodes."""
    nodes = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("node_id"), F.col("n_regionkey").cast("string").alias("law_key"), F.col("n_regionkey").cast("int").alias("section_num"), F.col("n_name").alias("moment"))
    k = F.col("s_suppkey")
    kind = F.when(k % 5 == 0, "DEFINES").when(k % 3 == 0, "EXCEPTS").otherwise("REFERS_TO")
    edges = table(spark, d, "supplier").select(k.cast("string").alias("source"), F.col("s_nationkey").cast("string").alias("target"), kind.alias("edge_type"))
    return graph.section_lookup(nodes, edges, "2", 2)[1].select("target", "source", "edge_type")


@query(f"WITH {hits_sql(LANGUAGES, LANGUAGE_PROFILE)}, {diverse_sql(LANGUAGE_PROFILE)} SELECT question_id, src, id, score FROM final QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY rank) = 1")
def autofill_first(spark: SparkSession, d: str) -> DataFrame:
    """The expected hit of each question: the first of the full routed search."""
    from sparquill.operators import guided

    return guided.first_hits(search.multi_source(questions(spark, d), corpus(spark, d), LANGUAGES, LANGUAGE_PROFILE)).select("question_id", "src", "id", "score")


@query(f"""WITH {ASKED}, {CORPUS}, own AS (SELECT item_id AS question_id, lang AS wanted FROM benchmark JOIN documents ON doc_id = item_id),
near AS (SELECT question_id, src, id, round(list_dot_product(q, v), 6) AS score FROM asked JOIN own USING (question_id) JOIN corpus ON src = wanted QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) <= 5)
SELECT question_id, src, id, score, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS INT) AS rank FROM near WHERE score >= 0.1""")
def search_in_source(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "documents").select(F.col("doc_id").alias("question_id"), F.col("lang").alias("wanted"))
    return search.in_source(questions(spark, d).join(own, "question_id"), corpus(spark, d), 5, 0.1)


def _first_sources(spark: SparkSession, d: str) -> DataFrame:
    langs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("src"))
    asked = questions(spark, d).join(langs.withColumnRenamed("id", "question_id"), "question_id").select("question_id", F.array(F.col("src"), F.lit("es")).alias("expected_sources"))
    return evaluation.top_sources(asked, _hits(spark, d).join(langs, "id"))


TOP_SQL = f"""{HITS_SQL}, t AS (SELECT question_id, list(lang) AS got FROM hits JOIN documents ON doc_id = id WHERE rank <= 3 GROUP BY question_id),
c AS (SELECT q.question_id, coalesce(list_has_any(t.got, [d.lang, 'es']), false) AS passed FROM q JOIN documents d ON d.doc_id = q.question_id LEFT JOIN t USING (question_id))"""


@query(f"WITH {TOP_SQL} SELECT question_id, passed FROM c")
def top_source_cases(spark: SparkSession, d: str) -> DataFrame:
    return _first_sources(spark, d).select("question_id", "passed")


@query(f"WITH {TOP_SQL} SELECT CAST(sum(passed::INT) AS BIGINT) AS passed, count(*) AS total, CASE WHEN sum(passed::INT) >= 18 THEN 'excellent' WHEN sum(passed::INT) >= 15 THEN 'good' WHEN sum(passed::INT) >= 12 THEN 'fair' ELSE 'poor' END AS verdict FROM c")
def expert_verdict(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.verdict(_first_sources(spark, d))


@query(f"""WITH {STRICT_SQL}, k AS (SELECT want_src || '-' || coalesce(top_src, 'none') AS pair, CASE WHEN top_src IS NULL THEN 'A' WHEN top_src <> want_src THEN CASE WHEN pass_routing THEN 'D' ELSE 'A' END WHEN top_section <> want_section THEN CASE WHEN pass_strict THEN 'D' ELSE 'B' END
WHEN top_moment <> CAST(question_id % 2 AS VARCHAR) THEN CASE WHEN pass_strict THEN 'D' ELSE 'C' END WHEN pass_strict AND NOT top1_hit_strict THEN 'D' ELSE '?' END AS class FROM s)
SELECT 'class' AS dimension, class AS value, count(*) AS n FROM k GROUP BY class UNION ALL SELECT 'pair', pair, count(*) FROM k GROUP BY pair""")
def failure_pairs(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    found = evaluation.failure_class(c("expected"), c("top_src"), c("top_section"), c("top_moment"), c("pass_strict"), c("pass_routing"), c("top1_hit_strict"))
    pair = F.concat_ws("-", F.get("expected", F.lit(0))["src"], F.coalesce("top_src", F.lit("none")))
    return evaluation.failure_summary(_strict(spark, d).select(found.alias("class"), pair.alias("pair")))


def _evidence(spark: SparkSession, d: str) -> DataFrame:
    """Law hits are the vector hits, document hits the ten nearest documents; what is expected follows from the question's number."""
    q = F.col("question_id")
    some = lambda n, value: F.when(q % n == 0, value)
    asked = questions(spark, d).select(
        "question_id", (q % 10).cast("string").alias("want_section"), some(2, F.lit("1")).alias("want_moment"), some(5, F.lit("^(en|fr)")).alias("section_pattern"), some(7, F.lit("de")).alias("node_type"), some(3, F.lit("the")).alias("metric_name"),
        some(4, F.lit(0)).alias("page_from"), some(4, F.lit(3)).alias("page_to"), F.when(q % 6 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("Eau"), F.lit("sch"))).alias("terms"),
    )
    docs = top10(spark, d).select("question_id", F.col("id").cast("string").alias("node_id"), F.col("src").alias("node_type"), F.col("src").alias("title"), F.col("body").alias("text"), (F.col("id") % 9).cast("int").alias("page_num"))
    return evaluation.evidence_cases(asked, _hits(spark, d).select("question_id", "section", "moment"), docs)


EVIDENCE_SQL = f"""{HITS_SQL[: HITS_SQL.index(",\nasked AS")]}, {TOP10_SQL},
l AS (SELECT question_id, bool_or(section = CAST(question_id % 10 AS VARCHAR) AND (question_id % 2 <> 0 OR moment = '1')) AS law_pass FROM hits GROUP BY question_id),
x AS (SELECT question_id, src, lower(body || ' ' || src) AS low, src || chr(10) || id || chr(10) || body AS whole, id % 9 AS page FROM top),
m AS (SELECT question_id, bool_or((question_id % 5 <> 0 AND question_id % 7 <> 0 AND question_id % 3 <> 0 AND question_id % 4 <> 0) OR (question_id % 5 = 0 AND regexp_matches(whole, '^(en|fr)', 'i')) OR (question_id % 7 = 0 AND src = 'de') OR (question_id % 3 = 0 AND contains(low, 'the')) OR (question_id % 4 = 0 AND page BETWEEN 0 AND 3)) AS doc_pass,
             bool_or(contains(low, 'eau') OR contains(low, 'sch')) AS held FROM x GROUP BY question_id),
ev AS (SELECT q.question_id, coalesce(law_pass, false) AS law_pass, coalesce(doc_pass, false) AS doc_pass, question_id % 6 = 0 OR held IS NULL OR held AS evidence_pass FROM q LEFT JOIN l USING (question_id) LEFT JOIN m USING (question_id))"""


@query(f"WITH {EVIDENCE_SQL} SELECT question_id, law_pass, doc_pass, evidence_pass FROM ev")
def evidence_cases(spark: SparkSession, d: str) -> DataFrame:
    return _evidence(spark, d)


@query(f"WITH {EVIDENCE_SQL}, r AS (SELECT " + ", ".join(f"round(avg({x}_pass::INT::DOUBLE) + 1e-9, 4) AS {x}_rate" for x in ("law", "doc", "evidence")) + " FROM ev) " + gates_sql(GATES_DOCUMENT, "r"))
def document_gates(spark: SparkSession, d: str) -> DataFrame:
    phases = Phases(spark)
    rows = phases.latency(phases.run("evidence", _evidence(spark, d)))
    return measured(evaluation.gates(evaluation.rates(rows, law_rate="law_pass", doc_rate="doc_pass", evidence_rate="evidence_pass"), GATES_DOCUMENT))


def _graph_cases(spark: SparkSession, d: str) -> DataFrame:
    """Orders as questions: the first hit is the customer's nation, the path its lines, the support its suppliers."""
    k = F.col("o_orderkey")
    asked = table(spark, d, "orders").select(k.alias("question_id"), F.struct(F.when(k % 3 == 0, "law").alias("src"), F.when(k % 2 == 0, (k % 25).cast("string")).alias("section"), F.lit(None).cast("string").alias("moment")).alias("want"), (k % 4 < 2).alias("wants_refs"), (k % 5 == 0).alias("wants_exceptions"), (k % 7 == 0).alias("wants_other_law"))
    first = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(k.alias("question_id"), F.lit("law").alias("src"), F.col("c_nationkey").cast("string").alias("section"), F.lit("1").alias("moment"))
    lines = table(spark, d, "lineitem")
    n = F.col("l_linenumber")
    path = lines.select(F.col("l_orderkey").alias("question_id"), F.when(n == 1, "DEFINES").when(n == 2, "EXCEPTS").otherwise("REFERS_TO").alias("relation"), F.when(F.col("l_partkey") % 10 == 0, "external:1/2").otherwise("p").alias("target"))
    support = lines.filter("l_linenumber > 3").select(F.col("l_orderkey").alias("question_id"), F.col("l_suppkey").cast("string").alias("node_id"))
    return evaluation.graph_cases(asked, first, path, support)


GRAPH_SQL = """l AS (SELECT l_orderkey, bool_or(l_linenumber >= 2) AS refs, bool_or(l_partkey % 10 = 0) AS ext, count(*) FILTER (l_linenumber > 3) AS n FROM lineitem GROUP BY l_orderkey),
g AS (SELECT o_orderkey AS question_id, c_custkey IS NOT NULL AND (o_orderkey % 2 <> 0 OR c_nationkey = o_orderkey % 25) AS primary_pass, o_orderkey % 4 >= 2 OR coalesce(refs, false) AS path_pass,
      NOT (o_orderkey % 4 < 2 OR o_orderkey % 5 = 0) OR coalesce(n, 0) > 0 OR (o_orderkey % 7 = 0 AND coalesce(ext, false)) AS support_pass
      FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN l ON l_orderkey = o_orderkey)"""


@query(f"WITH {GRAPH_SQL} SELECT question_id, primary_pass, path_pass, support_pass FROM g")
def graph_question_cases(spark: SparkSession, d: str) -> DataFrame:
    return _graph_cases(spark, d)


@query(f"WITH {GRAPH_SQL}, r AS (SELECT " + ", ".join(f"round(avg({x}_pass::INT::DOUBLE) + 1e-9, 4) AS {x}_rate" for x in ("primary", "path", "support")) + " FROM g) " + gates_sql(GATES_GRAPH, "r"))
def graph_gates(spark: SparkSession, d: str) -> DataFrame:
    phases = Phases(spark)
    rows = phases.latency(phases.run("cases", _graph_cases(spark, d)))
    return measured(evaluation.gates(evaluation.rates(rows, primary_rate="primary_pass", path_rate="path_pass", support_rate="support_pass"), GATES_GRAPH))


@query("""WITH b AS (SELECT item_id AS question_id, text, item_id % 3 = 0 AS must, CASE WHEN item_id % 4 = 0 THEN 'hard' ELSE 'easy' END AS category FROM benchmark),
m AS (SELECT question_id, text, must, category, lower(text) AS own, unnest([regexp_replace(text, 'the', 'a', 'gi'), regexp_replace(text, 'on', 'upon', 'gi'), regexp_replace(text, 'sch', 's', 'gi'), regexp_replace(text, 'e', 'E', 'g')]) AS new, unnest(range(4)) AS pos FROM b),
f AS (SELECT * FROM m WHERE lower(new) <> own QUALIFY row_number() OVER (PARTITION BY question_id, lower(new) ORDER BY pos) = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY pos) AS no FROM f QUALIFY no <= 3)
SELECT question_id::VARCHAR AS question_id, text, 'base' AS test_type FROM b UNION ALL SELECT question_id || '-p' || no, new, 'synonym' FROM p WHERE CASE WHEN must THEN no <= 3 ELSE category = 'hard' AND no <= 2 END""")
def question_assembly(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("question_id")
    base = table(spark, d, "benchmark").select(F.col("item_id").alias("question_id"), "text").withColumn("must", q % 3 == 0).withColumn("category", F.when(q % 4 == 0, "hard").otherwise("easy"))
    made = documents.paraphrases(base, (("the", ("a",)), ("on", ("upon",)), ("sch", ("s",))))
    return documents.question_set(base, made, [], ("hard",)).select("question_id", "text", "test_type")


# Sources over files that are written first, one statute, document or rule file each.


@query(SQL["xml_ingest"])
def xml_by_source(spark: SparkSession, d: str) -> DataFrame:
    """xml_ingest of statute files, by Spark's own XML source."""
    path = fresh_path(spark, "statutes")
    sinks.write_files(statute_files(spark, d), path, "path", "xml")
    found = statutes.unique_ids(statutes.moments_of_files(spark, path, "Laki", "1/2020", "laki_1_2020", {"kolmas": ("third",)}))
    return found.select("node_id", "section_id", "section_num", "moment", "text", F.array_join("tags", ",").alias("tags"))


@query(SQL["doc_flatten"])
def doc_files(spark: SparkSession, d: str) -> DataFrame:
    """doc_flatten of whole JSON files, read once as VARIANT."""
    path = fresh_path(spark, "documents")
    docs = _talks(spark, d)
    sinks.write_files(docs.select(F.concat("city", F.lit(".json")).alias("name"), F.to_json(F.struct(*docs.columns)).alias("content")), path)
    return documents.document_graph(files.documents(spark, path))[0].select("node_id", "node_type", "title", "page_num", "parent_id", F.md5("text").alias("text_md5"))


@query("""SELECT p_partkey AS part, '# Act ' || p_partkey || chr(10) || chr(10) || '## ' || p_size || ' luku ' || p_type || chr(10) || chr(10) || '### 1 § ' || p_name || chr(10) || chr(10)
|| CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand || ' text' || chr(10) || chr(10) END || '- **a)** ' || p_name || chr(10) || CASE WHEN p_partkey % 2 = 0 THEN '  - inner' || chr(10) || chr(10) ELSE '' END || '- last' || chr(10) AS markdown FROM part""")
def act_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Acts written as XML files, rendered, written as a Markdown file each, and read back."""
    k, say = F.col("p_partkey"), F.lit
    inner = F.when(k % 2 == 0, "<list><item>inner</item></list>").otherwise("")
    said = F.when(k % 3 == 0, "<p> </p>").otherwise(F.concat(say("<p>"), "p_brand", say(" <i>text</i></p>")))
    xml = F.concat(
        say("<act>\n<docTitle><p>Act "), k.cast("string"), say("</p></docTitle><body><part><chapter><num>"), F.col("p_size").cast("string"), say(" luku</num><heading>"), "p_type", say("</heading><section><num>1 §</num><heading>"), "p_name",
        say("</heading>"), said, say("<list><item><label>a)</label><p>"), "p_name", say("</p>"), inner, say("</item><item>last</item></list></section></chapter></part></body></act>"),
    )
    source, target = fresh_path(spark, "acts"), fresh_path(spark, "markdown")
    sinks.write_files(spread(table(spark, d, "part"), "p_partkey").select(F.concat(k.cast("string"), say(".xml")).alias("name"), xml.alias("content")), source)
    made = statutes.act_markdown(statutes.files(spark, source))
    sinks.write_files(made.select(F.concat(F.regexp_extract("path", r"(\d+)\.xml$", 1), say(".md")).alias("name"), F.col("text").alias("content")), target)
    back = files.whole_texts(spark, target)
    return back.select(F.regexp_extract("path", r"(\d+)\.md$", 1).cast("bigint").alias("part"), F.col("text").alias("markdown"))


@query("""WITH n AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS line_no FROM conversations)
SELECT conv_id::BIGINT AS file_no, line_no::BIGINT AS line_no, CASE WHEN line_no % 7 = 3 THEN '{broken ' || turn ELSE '' END AS line FROM n WHERE line_no % 7 = 3""")
def bad_json_lines(spark: SparkSession, d: str) -> DataFrame:
    """Files of JSON lines, of which every seventh is broken: the broken ones with file and line number."""
    by = Window.partitionBy("conv_id").orderBy("turn", "role")
    rows = table(spark, d, "conversations").withColumn("line_no", F.row_number().over(by))
    line = F.when(F.col("line_no") % 7 == 3, F.concat(F.lit("{broken "), F.col("turn").cast("string"))).otherwise(F.to_json(F.struct("turn", "role", "text")))
    whole = rows.groupBy("conv_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("line_no", line.alias("l")))).getField("l"), "\n").alias("content"))
    path = fresh_path(spark, "lines")
    sinks.write_files(whole.select(F.concat("conv_id", F.lit(".jsonl")).alias("name"), "content"), path)
    found = files.bad_lines(spark, path, "turn int, role string, text string")
    return found.select(F.regexp_extract("file", r"(\d+)\.jsonl$", 1).cast("bigint").alias("file_no"), F.col("line_no").cast("bigint").alias("line_no"), "line")


@query("""WITH r AS (SELECT lang, 'w' || (doc_id % 5) AS word FROM documents), k AS (SELECT lang, list_sort(list_distinct(list(word))) AS words FROM r GROUP BY lang)
SELECT lang AS src, array_to_string(words, ',') AS keywords FROM k""")
def rule_file(spark: SparkSession, d: str) -> DataFrame:
    """Keyword lists by source written as a rule file and loaded."""
    path = fresh_path(spark, "rules")
    words = table(spark, d, "documents").groupBy("lang").agg(F.sort_array(F.collect_set(F.concat(F.lit("w"), (F.col("doc_id") % 5).cast("string")))).alias("words"))
    lists = words.agg(F.map_from_entries(F.collect_list(F.struct("lang", "words"))).alias("router_keywords"))
    sinks.write_files(lists.select(F.lit("router.json").alias("name"), F.to_json(F.struct("router_keywords")).alias("content")), path)
    loaded = files.rules(spark, f"{path}/router.json")
    return spark.createDataFrame([(s, ",".join(w)) for s, w in loaded.items()], "src string, keywords string")


@query("""SELECT item_id AS question_id, text, 'set_' || (item_id % 3) || CASE WHEN item_id % 2 = 0 THEN '.autofill.json' ELSE '.json' END AS source_file, CASE WHEN item_id % 2 = 0 THEN 'auto' ELSE 'orig' END AS kind FROM benchmark
WHERE item_id % 2 = 1 OR item_id % 5 <> 0""")
def question_files(spark: SparkSession, d: str) -> DataFrame:
    """Question sets as JSON arrays, original and autofilled; the failed ones of the latter are left out."""
    k = F.col("item_id")
    rows = table(spark, d, "benchmark").select(k.alias("id"), "text", F.when(k % 2 == 0, F.when(k % 5 == 0, "FAIL").otherwise("OK")).alias("autofill_status"))
    name = F.concat(F.lit("set_"), (F.col("id") % 3).cast("string"), F.when(F.col("id") % 2 == 0, ".autofill.json").otherwise(".json"))
    sets = rows.groupBy(name.alias("name")).agg(F.to_json(F.collect_list(F.struct("id", "text", "autofill_status"))).alias("content"))
    path, schema = fresh_path(spark, "questions"), "id long, text string, autofill_status string"
    sinks.write_files(sets, path)
    names = [f"{path}/set_{i}{end}" for i in range(3) for end in (".json", ".autofill.json")]
    of = lambda originals, filled: files.questions(spark, originals, filled, schema).select(F.col("id").alias("question_id"), "text", "source_file")
    plain = of(names[::2], []).withColumn("kind", F.lit("orig"))
    return plain.unionByName(of(names[::2], names[1::2]).withColumn("kind", F.lit("auto")))


@query("""SELECT p_partkey AS case_no, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '' END AS category, p_partkey % 5 = 0 AS abstain_expected, p_partkey % 7 = 0 AS confusion_fail, CASE WHEN p_partkey % 2 = 0 THEN p_size::DOUBLE ELSE 0 END AS latency_ms FROM part""")
def result_files(spark: SparkSession, d: str) -> DataFrame:
    """Case results of older and newer field names, written as JSON arrays and brought to one form."""
    k = F.col("p_partkey")
    cases = table(spark, d, "part")
    new = cases.filter(k % 2 == 0).select(k.cast("string").alias("id"), F.col("p_name").alias("category"), F.struct((k % 5 == 0).alias("must_abstain")).alias("expected"), (k % 7 == 0).alias("confusion_fail"), F.col("p_size").cast("double").alias("latency_ms"))
    old = cases.filter(k % 2 == 1).select(k.cast("string").alias("case_id"), (k % 5 == 0).alias("abstain_expected"), (k % 7 == 0).alias("confusion_fail"))
    parts = []
    for rows in (new, old):
        path = fresh_path(spark, "results")
        sinks.write_json_array(rows, path)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        parts.append(files.results(sinks.read_json_array(spark, path, schema)))
    return parts[0].unionByName(parts[1]).select(F.col("case_id").cast("bigint").alias("case_no"), "category", "abstain_expected", "confusion_fail", "latency_ms")


@query("""SELECT CASE lang WHEN 'en' THEN '007' ELSE '7' END AS law_key, count(*) AS n, CAST(sum(vec_id) AS BIGINT) AS ids FROM embeddings JOIN documents ON doc_id = vec_id WHERE lang IN ('en', 'de') GROUP BY lang""")
def vector_table_names(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose names look like one number stay apart."""
    path = fresh_path(spark, "vectors")
    lang = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), F.when(F.col("lang") == "en", "007").when(F.col("lang") == "de", "7").otherwise(F.col("lang")).alias("law_key"))
    files.write_vectors(table(spark, d, "embeddings").join(lang, "vec_id"), path, id_col="vec_id", files=2)
    return files.read_vectors(spark, path, ["007"]).unionByName(files.read_vectors(spark, path, ["7"])).groupBy("law_key").agg(F.count("*").alias("n"), F.sum("vec_id").alias("ids"))


@query("""SELECT cut, 'n' || c_nationkey AS law_key, c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 3 = 0 THEN 'new' WHEN c_custkey % 2 = 0 THEN 'later line' ELSE 'old' END AS text FROM customer, (VALUES ('one batch'), ('a file a batch')) v(cut)""")
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Rows that replace earlier ones of their id, by a later file or a later line, however files fall into micro-batches."""
    path, k = fresh_path(spark, "stream"), F.col("c_custkey")
    rows = table(spark, d, "customer").select(k.cast("string").alias("id"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("law_key"), k)
    line = lambda text: F.to_json(F.struct("id", "law_key", F.lit(text).alias("text")))
    first = rows.select(F.concat(F.pmod(k, F.lit(4)).cast("string"), F.lit(".jsonl")).alias("name"), F.concat(line("old"), F.when(k % 2 == 0, F.concat(F.lit("\n"), line("later line"))).otherwise("")).alias("l"))
    second = rows.filter(k % 3 == 0).select(F.concat(F.pmod(k, F.lit(2)).cast("string"), F.lit(".jsonl")).alias("name"), line("new").alias("l"))
    for i, part in enumerate((first, second)):
        sinks.write_files(part.groupBy("name").agg(F.array_join(F.sort_array(F.collect_list("l")), "\n").alias("content")), f"{path}/in/{i}")
    parts = []
    for cut, n in (("one batch", None), ("a file a batch", 1)):
        at = fresh_path(spark, "upsert")
        ingest.follow(spark, f"{path}/in/*", "id string, law_key string, text string", f"{at}/table", f"{at}/checkpoint", files_a_batch=n).awaitTermination()
        parts.append(ingest.read_latest(spark, f"{at}/table").select(F.lit(cut).alias("cut"), "law_key", "id", "text"))
    return parts[0].unionByName(parts[1])
