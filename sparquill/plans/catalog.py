"""Queries over the driver's tables, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.operators import routing, search
from sparquill.plans.rules import LANGUAGE_PROFILE, LANGUAGES, Profile, Router

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a task that works out texts and hits from the rows of a table.
SPREAD = 4096


def spread(rows: DataFrame, by: str) -> DataFrame:
    """rows dealt by a column to parts of about SPREAD rows. A table of short rows lies in few parts, and the work that follows
    from a row is no measure of its bytes; what is then ranked or joined by the column stays where it is."""
    return rows.repartition(max(1, -(-rows.count() // SPREAD)), by)


def query(sql: str | None = None):
    """Registers a query and its SQL twin under its name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# Questions and corpus: benchmark items with the vector of their number; documents with theirs, by language.


def questions(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("question_id"), "embedding")
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("question_id"), "text")
    return items.join(vectors, "question_id")


def corpus(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("src"), F.col("text").alias("body"))
    return vectors.join(docs, "id")


def _terms(column: str, terms: tuple[str, ...]) -> str:
    return " + ".join(f"CAST(contains({column}, '{t}') AS INT)" for t in terms) or "0"


def _any(column: str, terms: tuple[str, ...]) -> str:
    return "(" + (" OR ".join(f"contains({column}, '{t}')" for t in terms) or "false") + ")"


ASKED = "asked AS (SELECT b.item_id AS question_id, b.text, lower(b.text) AS low, e.embedding::DOUBLE[] AS q FROM benchmark b JOIN embeddings e ON e.vec_id = b.item_id)"
CORPUS = "corpus AS (SELECT e.vec_id AS id, d.lang AS src, e.label, e.embedding::DOUBLE[] AS v, d.text AS body FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id)"


def route_sql(router: Router, min_sources: int = 2) -> str:
    """CTEs up to `weights` (question_id, src, weight, route_pos) from `asked`."""
    scored = " UNION ALL ".join(
        f"SELECT question_id, low, text, '{src}' AS src, {i} AS src_ord, {_terms('low', router.keywords[src])}{f' + {router.anchor_bonus} * CAST({_any("low", router.anchors)} AS INT)' if src == router.core else ''} AS score, {router.priors[src]}::DOUBLE AS prior FROM asked"
        for i, src in enumerate(router.sources)
    )
    named = "CASE " + " ".join(f"WHEN contains(low, '{t}') THEN '{s}'" for t, s in router.explicit) + " " + " ".join(f"WHEN contains(text, '{t}') THEN '{s}'" for t, s in router.numbers) + " END"
    return f"""
scored AS (SELECT *, {named} AS named, {_any("low", router.anchors)} AS anchored FROM ({scored})),
moded AS (SELECT *, sum(CAST(score > 0 AS INT)) OVER (PARTITION BY question_id) AS matched,
                 row_number() OVER (PARTITION BY question_id, src IS NOT DISTINCT FROM named ORDER BY score DESC, src_ord) AS other_pos,
                 prior + CASE WHEN score > 0 THEN 0.2::DOUBLE * score ELSE 0 END AS raised FROM scored),
placed AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY raised DESC, src_ord) AS by_raise,
                  CASE WHEN named IS NOT NULL THEN 'named' WHEN matched < {min_sources} THEN 'prior' ELSE 'share' END AS mode FROM moded),
kept AS (SELECT * FROM placed WHERE CASE mode WHEN 'named' THEN src = named OR other_pos = 1 WHEN 'prior' THEN by_raise <= greatest({min_sources}, matched + 1) ELSE score > 0 END),
weighed AS (SELECT *, CASE mode WHEN 'named' THEN CASE WHEN src = named THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END
                           WHEN 'prior' THEN raised / sum(raised) OVER (PARTITION BY question_id) ELSE score::DOUBLE / (sum(score) OVER (PARTITION BY question_id))::DOUBLE END AS w0 FROM kept),
ranked AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY w0 DESC, src_ord) AS place, max(w0) OVER (PARTITION BY question_id) AS top FROM weighed),
marked AS (SELECT *, mode = 'share' AND anchored AND src = '{router.core}' AND place > 2 AS low_core FROM ranked),
lifted AS (SELECT *, CASE WHEN low_core THEN greatest(w0, top * {router.core_share}::DOUBLE) ELSE w0 END AS w1, bool_or(low_core) OVER (PARTITION BY question_id) AS lifts FROM marked),
weights AS (SELECT question_id, src, CASE WHEN lifts THEN w1 / sum(w1) OVER (PARTITION BY question_id) ELSE w1 END AS weight,
                   CAST(CASE mode WHEN 'named' THEN CASE WHEN src = named THEN 1 ELSE 2 END WHEN 'prior' THEN by_raise ELSE row_number() OVER (PARTITION BY question_id ORDER BY src_ord) END AS INT) AS route_pos FROM lifted)"""


def merge_sql(profile: Profile, core: str, name: str = "merged", taken: str = "taken") -> str:
    """CTE `name` from hits within their budgets: adjusted, filtered, ranked."""
    change = f"CASE WHEN router_place = 1 THEN {profile.router_bonus}::DOUBLE ELSE 0 END"
    change += "".join(f" + CASE WHEN contains(low, '{t}') AND src = '{s}' THEN {a}::DOUBLE ELSE 0 END" for t, s, a in profile.guards)
    if profile.mismatch_penalty:
        change += f" - CASE WHEN {_any('low', profile.mismatch_terms)} AND src <> '{core}' THEN {profile.mismatch_penalty}::DOUBLE ELSE 0 END"
    early, late = (f"WHERE score_original >= {profile.min_score}", "") if not profile.threshold_after else ("", f"WHERE score >= {profile.min_score}")
    return f"""
{name}_changed AS (SELECT *, round(score_original + ({change}), 6) AS score FROM {taken} {early}),
{name} AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, route_pos, src_rank) AS rank FROM {name}_changed {late})"""


def hits_sql(router: Router, profile: Profile) -> str:
    """CTEs up to `merged` (question_id, src, id, score, score_original, rank) of a routed search."""
    return f"""{ASKED}, {CORPUS}, {route_sql(router)},
budgets AS (SELECT *, greatest({profile.min_k}, CAST(ceil({profile.total_k}::DOUBLE * weight) AS INT)) AS k, row_number() OVER (PARTITION BY question_id ORDER BY weight DESC, route_pos) AS router_place FROM weights),
near AS (SELECT question_id, low, src, id, round(list_dot_product(q, v), 6) AS score_original FROM asked, corpus),
best AS (SELECT *, row_number() OVER (PARTITION BY question_id, src ORDER BY score_original DESC, id) AS src_rank FROM near),
taken AS (SELECT best.*, route_pos, router_place FROM best JOIN budgets USING (question_id, src) WHERE src_rank <= k),
{merge_sql(profile, router.core)}"""


def diverse_sql(profile: Profile, merged: str = "merged", final: str = "final") -> str:
    """CTE `final` from `merged`: the diversity swap."""
    k = profile.total_k
    return f"""
{final}_swaps AS (SELECT *, coalesce(max(CASE WHEN router_place = 1 THEN score END) OVER q, 0) AS best1, coalesce(max(CASE WHEN router_place = 2 THEN score END) OVER q, 0) AS best2,
                 coalesce(max(CASE WHEN router_place = 2 AND rank <= {k} THEN 1 END) OVER q, 0) AS shown, min(CASE WHEN router_place = 2 AND rank > {k} THEN rank END) OVER q AS tail
          FROM {merged} WINDOW q AS (PARTITION BY question_id)),
{final} AS (SELECT question_id, src, id, score, score_original,
                 CASE WHEN abs(best1 - best2) < {profile.diversity_gap} AND shown = 0 AND tail IS NOT NULL AND rank = tail THEN {k} ELSE rank END AS rank
          FROM {final}_swaps WHERE NOT (abs(best1 - best2) < {profile.diversity_gap} AND shown = 0 AND tail IS NOT NULL AND rank = {k}))"""


def hundredths(spark: SparkSession, d: str) -> DataFrame:
    """The stated query set of the searches: every vector whose id is divisible by 100."""
    return table(spark, d, "embeddings").filter("vec_id % 100 = 0").select(F.col("vec_id").alias("question_id"), "embedding")


def _topk_sql(where: str = "true") -> str:
    score = "round(list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6)"
    return f"SELECT q.vec_id AS question_id, e.vec_id AS id, {score} AS score FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0 AND {where} QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY score DESC, e.vec_id) <= 5"


@query(_topk_sql())
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    return search.topk(hundredths(spark, d), table(spark, d, "embeddings"), 5, id_col="vec_id").select("question_id", "id", "score")


@query(_topk_sql("e.label BETWEEN 1 AND 4"))
def vector_topk_filtered(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings").filter(F.col("label").between(1, 4))
    return search.topk(hundredths(spark, d), vectors, 5, id_col="vec_id").select("question_id", "id", "score")


@query(f"WITH {ASKED}, {route_sql(LANGUAGES)} SELECT question_id, src, round(weight, 6) AS weight, route_pos FROM weights")
def route_weights(spark: SparkSession, d: str) -> DataFrame:
    return routing.route(questions(spark, d), LANGUAGES).withColumn("weight", F.round("weight", 6))


@query(f"WITH {ASKED}, {route_sql(LANGUAGES)} SELECT question_id, src, greatest(2, CAST(ceil(10::DOUBLE * weight) AS INT)) AS k FROM weights")
def k_budget(spark: SparkSession, d: str) -> DataFrame:
    return routing.budget(routing.route(questions(spark, d), LANGUAGES), 10, 2).select("question_id", "src", "k")


@query("SELECT doc_id, CASE " + " ".join(f"WHEN contains(lower(text), '{t}') THEN '{s}'" for t, s in LANGUAGES.explicit) + " " + " ".join(f"WHEN contains(text, '{t}') THEN '{s}'" for t, s in LANGUAGES.numbers) + " END AS named FROM documents")
def explicit_reference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", routing.explicit_source(F.col("text"), LANGUAGES).alias("named"))


PLAIN = Profile(min_score=0.05)
GUIDED = Profile(min_score=0.05, threshold_after=True, router_bonus=0.02, mismatch_penalty=0.03, mismatch_terms=LANGUAGES.anchors)


@query(f"WITH {hits_sql(LANGUAGES, PLAIN)} SELECT question_id, CAST(rank AS INT) AS rank, src, id, score, score_original FROM merged WHERE rank <= {PLAIN.limit}")
def multi_source_topk(spark: SparkSession, d: str) -> DataFrame:
    return search.multi_source(questions(spark, d), corpus(spark, d), LANGUAGES, PLAIN)


@query(f"WITH {hits_sql(LANGUAGES, LANGUAGE_PROFILE)}, {diverse_sql(LANGUAGE_PROFILE)} SELECT question_id, CAST(rank AS INT) AS rank, src, id, score, score_original FROM final WHERE rank <= {LANGUAGE_PROFILE.limit}")
def multi_source_rerank(spark: SparkSession, d: str) -> DataFrame:
    return search.multi_source(questions(spark, d), corpus(spark, d), LANGUAGES, LANGUAGE_PROFILE)


@query(f"WITH {hits_sql(LANGUAGES, GUIDED)} SELECT question_id, CAST(rank AS INT) AS rank, src, id, score, score_original FROM merged WHERE rank <= {GUIDED.limit}")
def guided_profile(spark: SparkSession, d: str) -> DataFrame:
    return search.multi_source(questions(spark, d), corpus(spark, d), LANGUAGES, GUIDED)


COMPANY, MUNICIPAL = ("the", "tion", "que", "eau", "her"), ("der", "sch", "los", "ung", "ción", "oui")
FAN_SQL = f"""{ASKED}, {CORPUS},
near AS (SELECT question_id, low, src, id, round(list_dot_product(q, v), 6) AS score FROM asked, corpus),
best AS (SELECT *, row_number() OVER (PARTITION BY question_id, src ORDER BY score DESC, id) AS src_rank FROM near),
fan AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, src, src_rank) AS rank FROM best WHERE src_rank <= 3 AND score >= 0.04)"""


@query(f"""WITH {FAN_SQL},
counted AS (SELECT *, {_terms("low", COMPANY)} AS company, {_terms("low", MUNICIPAL)} AS core_hits FROM fan WHERE rank <= 10),
boosted AS (SELECT question_id, src, id, rank, round(score + CASE WHEN company >= 2 THEN CASE src WHEN 'fr' THEN 0.08::DOUBLE WHEN 'en' THEN -0.03::DOUBLE ELSE 0 END
  WHEN core_hits >= 1 AND company = 0 THEN CASE WHEN src = 'en' THEN 0.08::DOUBLE WHEN src IN ('de', 'es') THEN -0.05::DOUBLE ELSE 0 END ELSE 0 END, 6) AS score FROM counted)
SELECT question_id, CAST(row_number() OVER (PARTITION BY question_id ORDER BY score DESC, rank) AS INT) AS rank, src, id, score FROM boosted""")
def fanout_boost(spark: SparkSession, d: str) -> DataFrame:
    asked = questions(spark, d)
    found = search.fan_out(asked, corpus(spark, d), 3, 0.04, 10)
    return search.context_boost(found, asked, COMPANY, MUNICIPAL, "fr", "en", ("de", "es"))
