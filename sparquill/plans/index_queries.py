"""Catalog: indexed search and rules that come as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.operators import documents, graph, matching, rerank, routing, search, text_index, vector_index
from sparquill.plans.catalog import ASKED, SQL, hundredths, query, questions, route_sql, table
from sparquill.plans.graph_queries import ASKED_TABLES, _customers, _parts, support_score
from sparquill.plans.rerank_queries import TOP10_SQL, top10
from sparquill.plans.rules import LANGUAGES
from sparquill.plans.source_queries import node_lookup  # noqa: F401  its SQL is taken over
from sparquill.sources import files
from sparquill.staging import fresh_path

#: The vectors of the given tables are noise without clusters, so near vectors lie in many cells.
CELLS, PROBES = 128, 84


def _index(spark: SparkSession, d: str) -> str:
    path = fresh_path(spark, "index")
    vector_index.build(table(spark, d, "embeddings"), path, CELLS, id_col="vec_id")
    return path


@query()
def vector_topk_indexed(spark: SparkSession, d: str) -> DataFrame:
    """vector_topk by the index: some of the nearest may be missed."""
    return vector_index.search(hundredths(spark, d), _index(spark, d), 5, PROBES).select("question_id", "id", "score")


@query("SELECT (SELECT count(*) FROM embeddings WHERE vec_id % 100 = 0) AS questions, count(*) AS n_indexed, true AS recalled, true AS spared FROM embeddings")
def vector_index_report(spark: SparkSession, d: str) -> DataFrame:
    """Whether the index finds at least 95 of 100 of the hits of the exact search and reads less than three quarters of the rows."""
    path, asked = _index(spark, d), hundredths(spark, d)
    found = vector_index.search(asked, path, 5, PROBES)
    exact = search.topk(asked, table(spark, d, "embeddings"), 5, id_col="vec_id")
    read = vector_index.rows_read(asked, path, PROBES).agg(F.count("*").alias("questions"), F.max("n_indexed").alias("n_indexed"), F.avg("n_rows").alias("n_rows"))
    return read.join(vector_index.recall(found, exact)).select("questions", "n_indexed", (F.col("recall") >= 0.95).alias("recalled"), (F.col("n_rows") < 0.75 * F.col("n_indexed")).alias("spared"))


WORDS_SQL = "words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS keyword FROM benchmark)"


def words(spark: SparkSession, d: str) -> DataFrame:
    """A rules table as large as the benchmark's vocabulary: its words of four or more letters."""
    return table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("keyword")).distinct()


@query(f"""WITH {WORDS_SQL}, h AS (SELECT doc_id, list_sort(list_distinct(flatten(list([substr(keyword, 1, 2), 'n' || length(keyword)])))) AS tags FROM documents JOIN words ON contains(lower(text), keyword) GROUP BY doc_id)
SELECT doc_id, coalesce(array_to_string(tags, ','), '') AS tags FROM documents LEFT JOIN h USING (doc_id)""")
def keyword_tags_table(spark: SparkSession, d: str) -> DataFrame:
    """Every word is a rule with two tags."""
    rules = words(spark, d).select("keyword", F.explode(F.array(F.substring("keyword", 1, 2), F.concat(F.lit("n"), F.length("keyword").cast("string")))).alias("tag"))
    return table(spark, d, "documents").select("doc_id", F.array_join(matching.labels(F.lower("text"), rules), ",").alias("tags"))


@query(f"WITH {ASKED}, {route_sql(LANGUAGES)} SELECT question_id, src, round(weight, 6) AS weight, route_pos FROM weights")
def route_by_table(spark: SparkSession, d: str) -> DataFrame:
    """route_weights with the keywords as a table."""
    keywords = spark.createDataFrame([(s, k) for s, ks in LANGUAGES.keywords.items() for k in ks], "src string, keyword string")
    return routing.route(questions(spark, d), LANGUAGES, keywords=keywords).withColumn("weight", F.round("weight", 6))


@query(f"""WITH {TOP10_SQL}, {WORDS_SQL},
r AS (SELECT keyword, CAST(length(keyword) % 10 AS VARCHAR) AS section, CASE WHEN length(keyword) % 3 = 0 THEN CAST(ascii(keyword) % 2 AS VARCHAR) END AS moment, round((ascii(keyword) % 7 - 2) / 100.0, 2)::DOUBLE AS change FROM words),
c AS (SELECT question_id, top.rank, sum(change) AS change FROM top JOIN r ON contains(low, keyword) AND section = CAST(label AS VARCHAR) AND (moment IS NULL OR moment = CAST(id % 2 AS VARCHAR)) GROUP BY ALL),
b AS (SELECT top.question_id, top.id, top.rank, top.score, greatest(least(coalesce(round(change, 9), 0), top.score * 0.2), -top.score * 0.2) AS boost FROM top LEFT JOIN c ON c.question_id = top.question_id AND c.rank = top.rank),
s AS (SELECT question_id, id, rank AS old, round(greatest(score + boost, 0), 4) AS score, round(boost, 4) AS boost_applied FROM b)
SELECT question_id, id, score, boost_applied, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, old) AS INT) AS rank FROM s""")
def rule_boost_table(spark: SparkSession, d: str) -> DataFrame:
    """A boost or penalty a word, for hits of the section that its length names."""
    k = F.col("keyword")
    moment = F.when(F.length(k) % 3 == 0, (F.ascii(k) % 2).cast("string"))
    rules = words(spark, d).select(k.alias("rule_id"), k.alias("term"), (F.length(k) % 10).cast("string").alias("section"), moment.alias("moment"), F.round((F.ascii(k) % 7 - 2) / 100, 2).alias("change"))
    hits = top10(spark, d).withColumns({"section_id": F.col("label").cast("string"), "moment": (F.col("id") % 2).cast("string")})
    return rerank.boost_by_table(hits.drop("text", "low"), questions(spark, d), rules).select("question_id", "id", "score", "boost_applied", "rank")


@query(SQL["table_search"])
def table_search_indexed(spark: SparkSession, d: str) -> DataFrame:
    """table_search by a stored index of names and titles."""
    path = fresh_path(spark, "names")
    rows = table(spark, d, "part").select(F.col("p_brand").alias("row_name"), F.col("p_type").alias("table_title"), "p_partkey")
    documents.index_tables(rows, path)
    asked = spark.createDataFrame(list(enumerate(ASKED_TABLES)), "question_id int, text string")
    return documents.search_tables(asked, rows, order=("p_partkey",), index=path).select("question_id", "p_partkey", "points", "rank")


@query(SQL["node_lookup"])
def node_lookup_indexed(spark: SparkSession, d: str) -> DataFrame:
    """node_lookup by a stored index of ids."""
    path = fresh_path(spark, "ids")
    nodes = _customers(spark, d).withColumn("node_id", F.col("node_id").cast("string"))
    graph.index_ids(nodes, path)
    return graph.lookup_indexed(nodes, path, "77").select("node_id", "law_key")


@query(f"WITH {WORDS_SQL}, t AS (SELECT doc_id, lower(text) AS low FROM documents) SELECT keyword, count(*) AS n_docs, min(doc_id) AS first_id FROM words JOIN t ON contains(low, keyword) GROUP BY keyword")
def word_documents(spark: SparkSession, d: str) -> DataFrame:
    """How many documents hold each word of the benchmark, and the first: from the posting lists of an index of all documents."""
    path = fresh_path(spark, "texts")
    text_index.build(table(spark, d, "documents"), path, id_col="doc_id")
    return text_index.find(spark, path, words(spark, d), "keyword").groupBy("keyword").agg(F.count("*").alias("n_docs"), F.min("id").alias("first_id"))


@query(SQL["neighbor_score"])
def neighbor_score_stored(spark: SparkSession, d: str) -> DataFrame:
    """neighbor_score over a stored adjacency, bucketed by node."""
    nodes, edges, primaries = _parts(spark, d)
    path = fresh_path(spark, "adjacency")
    graph.store_adjacency(edges, path, int(spark.conf.get("spark.sql.shuffle.partitions")), ("walk",))
    found = graph.expand(primaries, nodes, walk=graph.stored(spark, path, "walk"), value=support_score)
    return found.select("primary", "node_id", "hop", "relation", F.col("score").alias("support_score"))


@query("""WITH e AS (SELECT s_suppkey AS source, s_nationkey AS target FROM supplier)
SELECT 's' || source AS node_id, count(*) AS n_out, 0::BIGINT AS n_in FROM e GROUP BY source UNION ALL SELECT 'n' || target, 0, count(*) FROM e GROUP BY target""")
def graph_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Degrees of a graph that was written, read back and stored by node."""
    path = fresh_path(spark, "graph")
    name = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    suppliers = table(spark, d, "supplier")
    nodes = suppliers.select(name("s", "s_suppkey").alias("node_id"), F.lit("SUPPLIER").alias("node_type"))
    edges = suppliers.select(name("s", "s_suppkey").alias("source"), name("n", "s_nationkey").alias("target"), F.lit("REFERS_TO").alias("edge_type"), F.col("s_suppkey").alias("edge_ord"))
    files.write_graph(nodes, edges, path)
    graph.store_adjacency(files.read_graph(spark, path)[1], path, 8)
    return graph.stored(spark, path).groupBy(F.col("node").alias("node_id")).agg(F.sum(1 - F.col("back")).alias("n_out"), F.sum("back").cast("long").alias("n_in"))
