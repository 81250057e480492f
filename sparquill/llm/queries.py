"""Queries of the numbered operators, each over its whole tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.llm import centroids, classifier, decontaminate, hard_negatives, line_dedup, mixing, quality_rules, rotated_codes, sharding, simhash, token_ids, url_filters, warc
from sparquill.llm.common import read_table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup(read_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = token_ids.write_shards(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_ids.read_shards(manifest)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(warc.write_archives(read_table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = url_filters.with_labels(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))
    return url_filters.judge(pages)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    weights = classifier.fit(docs, labels.filter(~classifier.held_out(F.col("doc_id"))))
    scored = classifier.score(docs, weights)
    return scored.select("doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(*centroids.cluster(read_table(spark, sf_dir, "embeddings")))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return rotated_codes.search(rotated_codes.build(vectors), vectors.filter(F.col("vec_id") % 50 == 0))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(read_table(spark, sf_dir, "embeddings"), label)
    return hard_negatives.mine(rows, F.col("id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_line_dedup, op3_token_ids, op4_warc, op5_url_filters, op6_mixing, op7_decontaminate, op8_sharding, op9_simhash, op10_quality_classifier, op11_centroids, op12_nearest, op13_hard_negatives)}


OP2_SQL = """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d),
w AS (SELECT doc_id, i, 2 AS n, row_number() OVER (PARTITION BY lines[i] || chr(10) || lines[i + 1] ORDER BY doc_id, i) AS place FROM l WHERE i < len(lines)
      UNION ALL SELECT doc_id, i, 1, row_number() OVER (PARTITION BY lines[i] ORDER BY doc_id, i) FROM l WHERE len(regexp_extract_all(lines[i], '[^ \\t-\\r]+')) >= 50),
g AS (SELECT DISTINCT doc_id, i + o AS i FROM w, range(2) AS r(o) WHERE place > 1 AND o < n),
k AS (SELECT l.doc_id, string_agg(l.lines[l.i], chr(10) ORDER BY l.i) AS text, count(*) AS kept FROM l LEFT JOIN g USING (doc_id, i) WHERE g.i IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(len(d.lines), 0)::BIGINT AS n_lines, (coalesce(len(d.lines), 0) - coalesce(k.kept, 0))::BIGINT AS n_removed, sha256(coalesce(k.text, '')) AS text_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha256(html) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY digest)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN f.first_id IS NOT NULL AND d.page_id IS DISTINCT FROM f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id IS DISTINCT FROM f.first_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest
"""


HASH60 = "CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT)"

OP6_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0)::BIGINT AS size, {HASH60} AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS ord FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((ord - 1) % 3 + 1)::INT]::BIGINT AS weight, source_size * 3 AS most, (sum(source_size) OVER ())::BIGINT AS budget FROM s),
f AS (SELECT *, row_number() OVER o AS place,
             (budget - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT::DOUBLE
             / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT::DOUBLE AS level
      FROM w WINDOW o AS (ORDER BY most::DOUBLE / weight::DOUBLE, ord)),
l AS (SELECT level FROM f WHERE NOT most::DOUBLE / weight::DOUBLE < level ORDER BY place LIMIT 1),
t AS (SELECT source, ord, source_size, budget, least(most::DOUBLE, weight::DOUBLE * l.level) AS target FROM f, l),
q AS (SELECT d.doc_id, d.size, d.h, t.*, (sum(d.size) OVER (PARTITION BY t.ord ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING))::BIGINT AS upto,
             row_number() OVER () AS row_no
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT row_no, size, ord, budget, (upto + e * source_size)::DOUBLE / target AS finish FROM q, range(3) AS r(e) WHERE size > 0),
g AS (SELECT row_no, size FROM (SELECT *, sum(size) OVER (ORDER BY finish, ord) AS spent FROM c) WHERE spent <= budget),
k AS (SELECT row_no, sum(size)::BIGINT AS taken FROM g GROUP BY row_no)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN k USING (row_no)
"""

OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes, {HASH60} AS h, row_number() OVER () AS row_no FROM documents),
n AS (SELECT doc_id, n_bytes, h, row_no, b::INT AS local_depth,
             (sum(n_bytes) OVER (PARTITION BY b, h >> (60 - b)))::BIGINT AS shard_bytes, count(*) OVER (PARTITION BY b, h >> (60 - b)) AS shard_docs
      FROM d, range(24) AS r(b))
SELECT doc_id, n_bytes, CASE WHEN local_depth = 0 THEN '' ELSE substr(lpad(bin(h), 60, '0'), 1, local_depth) END AS shard, local_depth, shard_bytes, shard_docs
FROM n WHERE shard_bytes <= 64 * 1048576 OR shard_docs = 1
QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY local_depth) = 1
"""


def op11_sql(k: int = centroids.K, rounds: int = centroids.ROUNDS) -> str:
    """The rounds one after another, every distance measured."""
    near = """SELECT v.vec_id, v.row_no, v.x, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS distance
              FROM v, c{0} AS c QUALIFY row_number() OVER (PARTITION BY v.row_no ORDER BY distance, c.cluster) = 1"""
    parts = [
        """v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS row_no, embedding, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
           WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), embedding) - 1 AS cluster, x FROM v ORDER BY cluster LIMIT {k})",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(r)})")
        parts.append(f"""m{r} AS (SELECT cluster, list(m ORDER BY i) AS x FROM (SELECT cluster, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS m FROM a{r}, range(1, 65) AS p(i) GROUP BY cluster, i) GROUP BY cluster)""")
        parts.append(f"c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{r}.x, c{r}.x) AS x FROM c{r} LEFT JOIN m{r} USING (cluster))")
    return f"""WITH {", ".join(parts)}, a AS MATERIALIZED ({near.format(rounds)})
SELECT a.vec_id, a.cluster::INT AS cluster, a.distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia, (sum(a.distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a JOIN c{rounds} AS c USING (cluster)"""


OP12_SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding) AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
n AS MATERIALIZED (SELECT vec_id, x, sqrt(list_reduce(list_transform(x, lambda e: e * e), lambda a, b: a + b)) AS n FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i]), lambda a, b: a + b) / (q.n * c.n) AS score
      FROM n AS q JOIN n AS c ON len(q.x) = len(c.x) AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s QUALIFY rank <= 5
"""

OP13_SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, coalesce(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])), 0)::BIGINT AS score
      FROM v AS a JOIN v AS b ON len(a.x) = len(b.x) AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": OP2_SQL, "op4_warc": OP4_SQL, "op6_mixing": OP6_SQL, "op8_sharding": OP8_SQL, "op11_centroids": op11_sql(), "op12_nearest": OP12_SQL, "op13_hard_negatives": OP13_SQL}
