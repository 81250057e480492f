"""Catalog: reranking and enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.functions.text import section_parts
from sparquill.operators import enrich, evaluation, rerank, search
from sparquill.plans.catalog import ASKED, CORPUS, _any, corpus, query, questions, table
from sparquill.plans.rules import LANGUAGE_BOOSTS

TOP10_SQL = f"""{ASKED}, {CORPUS},
near AS (SELECT question_id, low, text, id, src, label, body, round(list_dot_product(q, v), 6) AS score FROM asked, corpus),
top AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, id) AS rank FROM near QUALIFY rank <= 10)"""
WORDS_SQL = r"regexp_extract_all({0}, '[\p{{L}}\p{{N}}_]+')"


def top10(spark: SparkSession, d: str) -> DataFrame:
    """The ten nearest documents of each question with label and text; texts join after the search."""
    found = search.topk(questions(spark, d), table(spark, d, "embeddings").join(table(spark, d, "documents").select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi"), 10, id_col="vec_id")
    return found.join(corpus(spark, d).drop("embedding"), "id")


def _rule_sql() -> str:
    parts = [f"CASE WHEN {_any('low', terms)} AND CAST(label AS VARCHAR) = '{of}'" + ("" if at is None else f" AND CAST(id % 2 AS VARCHAR) = '{at}'") + f" THEN {add}::DOUBLE ELSE 0 END" for terms, of, at, add in LANGUAGE_BOOSTS.boosts]
    parts += [f"CASE WHEN {_any('low', terms)} AND CAST(label AS VARCHAR) = '{of}' THEN {add}::DOUBLE ELSE 0 END" for terms, of, add in LANGUAGE_BOOSTS.penalties]
    return " + ".join(parts)


def _anchors() -> Column:
    """The first two words of w as one anchor, its first and its third."""
    word = lambda i: F.get("w", F.lit(i))
    return F.filter(F.array(F.concat(word(0), F.lit(" "), word(1)), word(0), word(2)), lambda a: a.isNotNull())


@query(f"""WITH {TOP10_SQL},
parts AS (SELECT *, {WORDS_SQL.format('low')} AS w, {WORDS_SQL.format('lower(body)')} AS b FROM top),
terms AS (SELECT *, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS t, [b[1] || ' ' || b[2], b[1], b[3]] AS anchors FROM parts),
counted AS (SELECT *, len(list_filter(anchors, lambda a: a IS NOT NULL AND (list_contains(t, a) OR len(list_filter(string_split(a, ' '), lambda x: NOT list_contains(t, x))) = 0))) AS overlap FROM terms),
changed AS (SELECT *, {_rule_sql()} + CASE WHEN {_any('low', LANGUAGE_BOOSTS.overlap_terms)} AND CAST(label AS VARCHAR) IN {LANGUAGE_BOOSTS.overlap_sections} THEN least(0.01::DOUBLE * overlap, 0.05::DOUBLE) ELSE 0 END AS change FROM counted),
held AS (SELECT *, greatest(least(change, score * 0.05::DOUBLE), -(score * 0.05::DOUBLE)) AS applied FROM changed),
done AS (SELECT question_id, id, rank AS old, round(greatest(score + applied, 0) + 1e-9, 4) AS score, round(applied + sign(applied) * 1e-9, 4) AS boost_applied FROM held)
SELECT question_id, id, score, boost_applied, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, old) AS INT) AS rank FROM done""")
def rule_boost_capped(spark: SparkSession, d: str) -> DataFrame:
    hits = top10(spark, d).withColumn("w", F.regexp_extract_all(F.lower("body"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    hits = hits.select("question_id", "id", "score", "rank", F.col("label").cast("string").alias("section_id"), (F.col("id") % 2).cast("string").alias("moment"), _anchors().alias("anchors"))
    boosted = rerank.boost(hits, questions(spark, d), LANGUAGE_BOOSTS)
    return boosted.select("question_id", "id", "score", "boost_applied", "rank")


@query(f"""WITH {TOP10_SQL},
parts AS (SELECT question_id, id, {WORDS_SQL.format('low')} AS w, {WORDS_SQL.format('lower(body)')} AS b FROM top),
terms AS (SELECT question_id, id, list_distinct(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS t, [b[1] || ' ' || b[2], b[1], b[3]] AS anchors FROM parts)
SELECT question_id, id, CAST(len(list_filter(anchors, lambda a: a IS NOT NULL AND (list_contains(t, a) OR len(list_filter(string_split(a, ' '), lambda x: NOT list_contains(t, x))) = 0))) AS INT) AS overlap FROM terms""")
def anchor_overlap(spark: SparkSession, d: str) -> DataFrame:
    words = F.regexp_extract_all(F.lower("body"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    hits = top10(spark, d).join(questions(spark, d).select("question_id", "text"), "question_id").withColumn("w", words)
    return hits.select("question_id", "id", rerank.anchor_overlap(_anchors(), rerank.query_terms(F.col("text"))).alias("overlap"))


@query(f"""WITH {TOP10_SQL},
terms AS (SELECT *, list_sort(list_distinct(regexp_extract_all(low, '[a-zäöå]{{4,}}')))[1:5] AS t FROM top),
counted AS (SELECT question_id, id, score, rank, len(list_filter(t, lambda x: contains(lower(body), x))) AS overlap FROM terms)
SELECT question_id, id, CAST(overlap AS INT) AS overlap, CASE WHEN overlap >= 1 OR score >= 0.3 THEN 'OK' ELSE 'FAIL' END AS status
FROM counted QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY overlap DESC, score DESC, rank) = 1""")
def autofill_expected(spark: SparkSession, d: str) -> DataFrame:
    terms = questions(spark, d).select("question_id", enrich.anchor_terms(F.col("text")).alias("terms"))
    return rerank.autofill(top10(spark, d).join(terms, "question_id"), "terms", "body", min_score=0.3).select("question_id", "id", "overlap", "status")


TAGS = {"the": ("article", "english"), "tion": ("noun",), "sch": ("german", "noun"), "eau": ("french",), "que": ("romance",), "!!": ("loud",)}


def _tags_sql(column: str) -> str:
    each = ", ".join(f"CASE WHEN contains({column}, '{k}') THEN {list(v)} ELSE [] END" for k, v in TAGS.items())
    return f"list_sort(list_distinct(flatten([{each}, ['default']])))"


@query(f"SELECT doc_id, array_to_string({_tags_sql('lower(text)')}, ',') AS tags FROM documents")
def keyword_tags(spark: SparkSession, d: str) -> DataFrame:
    tags = enrich.keyword_tags(F.col("text"), TAGS, F.array(F.lit("default")))
    return table(spark, d, "documents").select("doc_id", F.array_join(tags, ",").alias("tags"))


@query(f"""SELECT l.quality, count(*) AS n, round(avg(CASE WHEN d.source IN ('src1', 'src2', 'src3') OR list_has_any({_tags_sql('lower(d.text)')}, ['french', 'loud']) THEN 1.0::DOUBLE ELSE 0 END) + 1e-9, 4) AS hit_rate
FROM documents d JOIN labels l USING (doc_id) GROUP BY l.quality""")
def domain_filter_hitrate(spark: SparkSession, d: str) -> DataFrame:
    inside = enrich.domain_filter(F.col("source"), enrich.keyword_tags(F.col("text"), TAGS, F.array(F.lit("default"))), ("src1", "src2", "src3"), ("french", "loud"))
    rows = table(spark, d, "documents").select("doc_id", inside.alias("inside")).join(table(spark, d, "labels"), "doc_id")
    return rows.groupBy("quality").agg(F.count("*").alias("n"), evaluation.four(F.avg(F.col("inside").cast("double"))).alias("hit_rate"))


@query("""SELECT doc_id, CASE WHEN lang = 'en' THEN '§ ' || doc_id || ' ' || source || ': ' || text ELSE source || '. ' || text END AS body, left(text, 40) || CASE WHEN length(text) > 40 THEN '...' ELSE '' END AS preview
FROM documents WHERE length(regexp_replace(source || ' ' || text, '^\\s+|\\s+$', '', 'g')) >= 20""")
def embedding_text(spark: SparkSession, d: str) -> DataFrame:
    from sparquill.functions.text import preview

    docs = table(spark, d, "documents").filter(enrich.indexable(F.lit("PARA"), F.col("source"), F.col("text")))
    body = enrich.embedding_text(F.col("doc_id").cast("string"), F.col("source"), F.col("text"), F.col("lang") == "en")
    return docs.select("doc_id", body.alias("body"), preview(F.col("text"), 40).alias("preview"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
f AS (SELECT * FROM l WHERE NOT regexp_matches(line, '^\s*\d+\s*$')),
p AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY pos) AS last FROM f),
k AS (SELECT * FROM p WHERE CASE WHEN regexp_matches(line, '^\s*$') THEN coalesce(NOT regexp_matches(last, '^\s*$'), false) ELSE line IS DISTINCT FROM last END),
g AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM k GROUP BY doc_id)
SELECT d.doc_id, sha256(coalesce(g.text, '')) AS text_sha256 FROM documents d LEFT JOIN g USING (doc_id)""")
def line_clean(spark: SparkSession, d: str) -> DataFrame:
    return enrich.clean_lines(table(spark, d, "documents"), "doc_id", "text").select("doc_id", F.sha2("text", 256).alias("text_sha256"))


RAW_SQL = "CASE p_partkey % 4 WHEN 0 THEN '§ ' || p_size WHEN 1 THEN p_size || ' A §' WHEN 2 THEN ' ' || p_size || 'b' ELSE 'VII' END"


@query(rf"""WITH r AS (SELECT p_partkey, {RAW_SQL} AS raw FROM part), b AS (SELECT *, regexp_replace(raw, '[\s§]+', '', 'g') AS bare FROM r),
x AS (SELECT *, regexp_extract(bare, '^(\d+)([a-zA-Z]*)$', 1) AS digits, lower(regexp_extract(bare, '^(\d+)([a-zA-Z]*)$', 2)) AS suffix FROM b)
SELECT p_partkey, CASE WHEN digits = '' THEN bare ELSE digits || suffix END AS section_id, CASE WHEN digits = '' THEN 0 ELSE CAST(digits AS INT) END AS section_num, nullif(suffix, '') AS section_suffix,
       'fi:1:' || CASE WHEN digits = '' THEN bare ELSE digits || suffix END AS node_id FROM x""")
def section_id_parse(spark: SparkSession, d: str) -> DataFrame:
    from sparquill.functions.text import node_id

    n, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    raw = F.when(n == 0, F.concat(F.lit("§ "), size)).when(n == 1, F.concat(size, F.lit(" A §"))).when(n == 2, F.concat(F.lit(" "), size, F.lit("b"))).otherwise("VII")
    ident, number, suffix = section_parts(raw)
    return table(spark, d, "part").select("p_partkey", ident.alias("section_id"), number.alias("section_num"), suffix.alias("section_suffix"), node_id(F.lit("fi"), F.lit("1"), F.lit(""), ident).alias("node_id"))


STOP = ("with", "that", "this", "from", "eine", "para", "pour")


@query(rf"""WITH w AS (SELECT unnest(string_split_regex(trim(lower(text)), '\s+')) AS term FROM documents)
SELECT term, count(*) AS n FROM w WHERE length(term) > 3 AND term NOT IN {STOP} GROUP BY term ORDER BY n DESC, term LIMIT 20""")
def keyword_extract(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(enrich.keywords(F.col("text"), STOP).alias("words"))
    return enrich.most_common(docs, "words", 20)


@query("SELECT page_id, target, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS target FROM pages) GROUP BY ALL")
def html_links(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("target"))
    return links.groupBy("page_id", "target").agg(F.count("*").alias("n"))


@query(r"""WITH p AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) AS paras FROM pages)
SELECT page_id, title, CAST(len(paras) AS INT) AS n_paragraphs, md5(array_to_string(list_filter(list_transform(paras, lambda x: regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g')), lambda x: x <> ''), ' ')) AS body_md5 FROM p""")
def html_sections(spark: SparkSession, d: str) -> DataFrame:
    from sparquill.functions.text import strip

    paras = F.regexp_extract_all("html", F.lit(r"(?s)<p>(.*?)</p>"), F.lit(1))
    texts = F.filter(F.transform(paras, lambda x: strip(F.regexp_replace(x, "<[^>]*>", ""))), lambda x: x != "")
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"), F.size(paras).alias("n_paragraphs"), F.md5(F.array_join(texts, " ")).alias("body_md5"))
