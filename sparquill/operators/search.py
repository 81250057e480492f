"""Exact vector search and the merging of several sources' hits.

Questions are a stated set: tasks write them as files of at most `block` rows, and one scan of the corpus takes its vectors
chunk by chunk and each block of questions over a chunk, as a matrix product. A task keeps as many blocks as fit in `KEPT_BYTES`
and reads the others again for each chunk. A chunk passes on the best of each question and source only, which Spark trims to the
best of a task before the shuffle; no question passes through the driver, so hits are joined with questions by merging: Spark would
take a table of short, repetitive texts for a small one and send it to all tasks. Scores are rounded to six digits before
ranking; equal scores go to the smaller id. Rows without a source are searched as a source of their own, null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparquill.blocks import chunks, read_block, write_blocks
from sparquill.functions.text import hits as count_terms
from sparquill.functions.text import holds_any
from sparquill.operators import matching
from sparquill.operators.routing import budget, route
from sparquill.plans.rules import Profile, Router

BLOCK_QUESTIONS, CHUNK_BYTES, KEPT_BYTES = 4096, 32 << 20, 128 << 20


def topk(questions: DataFrame, corpus: DataFrame, k: int, key: str = "question_id", query_vector: str = "embedding", id_col: str = "id", vector: str = "embedding", source: str | None = None, block: int = BLOCK_QUESTIONS) -> DataFrame:
    """(key, [source,] id, score, rank): the k best rows of corpus for each question, by cosine of unit vectors, in each
    source if one is named. Filters on corpus go below the search. Rows without a vector are never hits."""
    asked = questions.select(F.col(key).alias("key"), F.col(query_vector).alias("q")).filter(F.col("q").isNotNull())
    rows = corpus.select(F.col(id_col).alias("id"), F.col(vector).alias("v"), (F.col(source) if source else F.lit("")).alias("src")).filter(F.col("v").isNotNull())
    kinds = f"key {asked.schema['key'].dataType.simpleString()}, id {rows.schema['id'].dataType.simpleString()}, src string, score double"
    found = rows.mapInArrow(_nearest(write_blocks(asked, block, "key", "questions"), k), kinds)
    best = Window.partitionBy("key", "src").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(F.col("key").alias(key), *([F.col("src").alias(source)] if source else []), "id", "score", "rank")


def _nearest(paths: list[str], k: int):
    """Of each chunk of rows, the k best for each question and source. Question blocks pass one by one over a chunk, so one
    scan serves all."""

    def load(path: str) -> tuple[pa.Array, np.ndarray]:
        table = read_block(path)
        return table["key"].combine_chunks(), np.stack(table["q"].to_numpy(zero_copy_only=False)).astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, tuple[pa.Array, np.ndarray]] = {}
        for chunk in chunks(batches, CHUNK_BYTES):
            v = pc.list_flatten(chunk["v"]).to_numpy().astype(np.float64).reshape(chunk.num_rows, -1)
            ids, src = chunk["id"].combine_chunks(), np.array(chunk["src"].to_pylist(), object)
            order = np.array(pc.sort_indices(ids))
            for path in paths:
                keys, queries = kept[path] if path in kept else load(path)
                if path not in kept and queries.nbytes + sum(q.nbytes for _, q in kept.values()) <= KEPT_BYTES:
                    kept[path] = keys, queries
                for s in sorted(set(src.tolist()), key=lambda x: (x is None, x)):
                    at = order[np.equal(src[order], s)]  # by id, so that equal scores keep the smaller ids
                    step = max(1, CHUNK_BYTES // (8 * len(at)))
                    for lo in range(0, len(keys), step):
                        asked, place, score = best_columns(np.round(queries[lo : lo + step] @ v[at].T, 6), k)
                        yield pa.RecordBatch.from_arrays([keys.take(pa.array(lo + asked)), ids.take(pa.array(at[place])), pa.array([s] * len(score), pa.string()), pa.array(score)], ["key", "id", "src", "score"])

    return run


def best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the k greatest of each row, of equals those of the first columns."""
    k = min(k, scores.shape[1])
    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
    row, col = np.nonzero(scores >= least)
    order = np.lexsort((col, -scores[row, col], row))
    row, col = row[order], col[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], col[keep], scores[row[keep], col[keep]]


def multi_source(questions: DataFrame, corpus: DataFrame, router: Router, profile: Profile, key: str = "question_id", text: str = "text", id_col: str = "id", source: str = "src", query_vector: str = "embedding", available: tuple[str, ...] | None = None) -> DataFrame:
    """Routed search: (key, rank, source, id, score, score_original). Route, share out k, search each source, adjust, filter
    by score, merge and cut. Ties keep the order of sources in the route, then the rank within a source."""
    found = topk(questions, corpus, max(profile.total_k, profile.min_k), key, query_vector, id_col, source=source)
    joined = within_budget(found.withColumnRenamed("rank", "src_rank"), questions, router, profile, key, text, source, available)
    return merge(joined, questions.select(key, text), profile, router.core, key, text, source)


def within_budget(hits: DataFrame, questions: DataFrame, router: Router, profile: Profile, key: str = "question_id", text: str = "text", source: str = "src", available: tuple[str, ...] | None = None) -> DataFrame:
    """The hits (key, source, src_rank) of the sources that each question is routed to, as many as its budget gives to each,
    with route_pos and router_place."""
    weights = budget(route(questions, router, available, key, text), profile.total_k, profile.min_k)
    weights = weights.withColumn("router_place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("weight"), "route_pos")))
    return hits.join(weights.withColumnRenamed("src", source).hint("merge"), [key, source]).filter(F.col("src_rank") <= F.col("k"))


def merge(hits: DataFrame, questions: DataFrame, profile: Profile, core: str, key: str = "question_id", text: str = "text", source: str = "src", guards: DataFrame | None = None) -> DataFrame:
    """Adjusts, filters, orders and cuts hits (key, source, id, score, src_rank, route_pos, router_place). Guards of a table
    (term, src, adjust) take the place of the profile's and are matched in one pass, however many they are."""
    rows = hits.join(questions.select(F.col(key), F.lower(text).alias("asked")).hint("merge"), key).withColumn("score_original", F.col("score"))
    if not profile.threshold_after:
        rows = rows.filter(F.col("score") >= profile.min_score)
    change = F.when(F.col("router_place") == 1, profile.router_bonus).otherwise(0.0)
    if guards is not None:
        held = questions.select(F.col(key), F.explode(matching.held(F.lower(F.col(text)), guards, "term")).alias("term"))
        due = held.join(guards, "term").groupBy(key, F.col("src").alias(source)).agg(F.round(F.sum("adjust"), 9).alias("guarded"))
        rows = rows.join(due.hint("merge"), [key, source], "left")
        change += F.coalesce("guarded", F.lit(0.0))
    for term, src, adjust in profile.guards if guards is None else ():
        change += F.when(F.contains("asked", F.lit(term)) & (F.col(source) == src), adjust).otherwise(0.0)
    if profile.mismatch_penalty:
        change -= F.when(holds_any(F.col("asked"), profile.mismatch_terms) & (F.col(source) != core), profile.mismatch_penalty).otherwise(0.0)
    rows = rows.withColumn("score", F.round(F.col("score") + change, 6))
    if profile.threshold_after:
        rows = rows.filter(F.col("score") >= profile.min_score)
    order = Window.partitionBy(key).orderBy(F.desc("score"), "route_pos", "src_rank")
    rows = rows.withColumn("rank", F.row_number().over(order))
    if profile.diversity_gap is not None:
        rows = diversified(rows, profile.diversity_gap, profile.total_k, key)
    return rows.filter(F.col("rank") <= profile.limit).select(key, F.col("rank").cast("int").alias("rank"), source, "id", "score", "score_original")


def diversified(rows: DataFrame, gap: float, total_k: int, key: str = "question_id") -> DataFrame:
    """Where the two first routed sources' best scores lie closer than gap (0 for a source without hits) and the second has
    hits but none among the first total_k, its best hit takes the last of these places; the row that it displaces goes."""
    q = Window.partitionBy(key)
    place = F.col("router_place")
    best = [F.coalesce(F.max(F.when(place == p, F.col("score"))).over(q), F.lit(0.0)) for p in (1, 2)]
    shown = F.coalesce(F.max(F.when((place == 2) & (F.col("rank") <= total_k), 1)).over(q), F.lit(0)) == 1
    first_tail = F.min(F.when((place == 2) & (F.col("rank") > total_k), F.col("rank"))).over(q)
    rows = rows.withColumn("swap", (F.abs(best[0] - best[1]) < gap) & ~shown & first_tail.isNotNull()).withColumn("from", first_tail)
    rows = rows.filter(~(F.col("swap") & (F.col("rank") == total_k)))
    return rows.withColumn("rank", F.when(F.col("swap") & (F.col("rank") == F.col("from")), total_k).otherwise(F.col("rank"))).drop("swap", "from")


def fan_out(questions: DataFrame, corpus: DataFrame, per_source: int = 3, min_score: float = 0.4, limit: int = 10, key: str = "question_id", id_col: str = "id", source: str = "src", query_vector: str = "embedding") -> DataFrame:
    """Unrouted search: the same k from every source, a threshold, one order, a limit."""
    found = topk(questions, corpus, per_source, key, query_vector, id_col, source=source).filter(F.col("score") >= min_score)
    order = Window.partitionBy(key).orderBy(F.desc("score"), source, "rank")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit).select(key, F.col("place").alias("rank"), source, "id", "score")


def in_source(questions: DataFrame, corpus: DataFrame, k: int = 5, min_score: float = 0.4, key: str = "question_id", wanted: str = "wanted", id_col: str = "id", source: str = "src", query_vector: str = "embedding") -> DataFrame:
    """Search in the one source that each question names: (key, source, id, score, rank) of its k best that reach min_score."""
    asked = questions.select(key, F.col(wanted).alias(source))
    of = corpus.join(asked.select(source).distinct(), source, "left_semi")  # sources that no question wants are not searched
    found = topk(questions, of, k, key, query_vector, id_col, source=source)
    return found.join(asked, [key, source], "left_semi").filter(F.col("score") >= min_score).select(key, source, "id", "score", "rank")


def context_boost(hits: DataFrame, questions: DataFrame, company: tuple[str, ...], core_terms: tuple[str, ...], company_source: str, core: str, accounting: tuple[str, ...], key: str = "question_id", text: str = "text", source: str = "src") -> DataFrame:
    """Two or more company terms: +.08 for the company source, -.03 for the core. Else one or more core terms and no company
    term: +.08 for the core, -.05 for the accounting sources. Ordered anew; ties keep their rank."""
    low = F.lower(F.col(text))
    asked = questions.select(key, count_terms(low, company).alias("company"), count_terms(low, core_terms).alias("core_hits"))
    rows = hits.join(asked.hint("merge"), key)
    change = F.when(F.col("company") >= 2, F.when(F.col(source) == company_source, 0.08).when(F.col(source) == core, -0.03).otherwise(0.0)).when(
        (F.col("core_hits") >= 1) & (F.col("company") == 0), F.when(F.col(source) == core, 0.08).when(F.col(source).isin(*accounting), -0.05).otherwise(0.0)
    )
    rows = rows.withColumn("score", F.round(F.col("score") + F.coalesce(change, F.lit(0.0)), 6))
    order = Window.partitionBy(key).orderBy(F.desc("score"), "rank")
    return rows.withColumn("rank", F.row_number().over(order)).select(key, "rank", source, "id", "score")
