"""Routing: which sources a question goes to, by keyword rules, and how many hits each may give.

The rules are configuration and are compiled into column expressions (keywords may come as a table instead), so routing is one narrow pass over the questions
and one small regrouping by question. Ties go to the source that comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions.text import hits, holds_any
from sparquill.operators import matching
from sparquill.plans.rules import Router


def explicit_source(question: Column, router: Router) -> Column:
    """The source that a question names: the first abbreviation or name held, else the first number held; else null."""
    low = F.lower(question)
    found = [F.when(F.contains(low, F.lit(term)), F.lit(src)) for term, src in router.explicit]
    found += [F.when(F.contains(question, F.lit(term)), F.lit(src)) for term, src in router.numbers]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def scores(questions: DataFrame, router: Router, available: tuple[str, ...] | None = None, text: str = "text", keywords: DataFrame | None = None) -> DataFrame:
    """A row a question and available source: the question's columns, src, src_ord, score, prior, anchored, named. Keywords
    (src, keyword) of a table take the place of the router's and are matched in one pass, however many they are."""
    if keywords is not None:
        questions = questions.withColumn("_held", matching.counts(F.lower(F.col(text)), keywords))
    wanted = [s for s in router.sources if available is None or s in available]
    low, anchored = F.lower(F.col(text)), holds_any(F.lower(F.col(text)), router.anchors)
    each = []
    for i, src in enumerate(wanted):
        matched = hits(low, router.keywords[src]) if keywords is None else F.coalesce(F.try_element_at("_held", F.lit(src)), F.lit(0))
        score = matched + (F.when(anchored, router.anchor_bonus).otherwise(0) if src == router.core else F.lit(0))
        each.append(F.struct(F.lit(src).alias("src"), F.lit(i).alias("src_ord"), score.alias("score"), F.lit(router.priors.get(src, router.other_prior)).alias("prior")))
    named = explicit_source(F.col(text), router)
    named = F.when(named.isin(wanted), named) if wanted else F.lit(None).cast("string")
    return questions.select("*", anchored.alias("anchored"), named.alias("named"), F.explode(F.array(*each)).alias("s")).select("*", "s.*").drop("s", "_held")


def route(questions: DataFrame, router: Router, available: tuple[str, ...] | None = None, key: str = "question_id", text: str = "text", min_sources: int = 2, keywords: DataFrame | None = None) -> DataFrame:
    """(key, src, weight, route_pos): the weights of the sources of each question. route_pos is a source's place among its
    question's, which decides ties later on.

    A named source gets .8 and the best other .2. With fewer than min_sources sources matched the priors, raised by .2 a
    match, are shared out among the best; else weights are shares of matches. An anchored question's core source is raised
    to core_share of the best weight if it is not among the best two.
    """
    q, by_order = Window.partitionBy(key), Window.partitionBy(key).orderBy("src_ord")
    rows = scores(questions, router, available, text, keywords).select(key, "src", "src_ord", "score", "prior", "anchored", "named")
    rows = rows.withColumn("matched", F.sum((F.col("score") > 0).cast("int")).over(q))
    is_named = F.col("src") == F.col("named")
    best_other = F.row_number().over(Window.partitionBy(key, F.coalesce(is_named, F.lit(False))).orderBy(F.desc("score"), "src_ord")) == 1
    raised = F.col("prior") + F.when(F.col("score") > 0, F.lit(0.2) * F.col("score")).otherwise(0.0)
    rows = rows.withColumn("raised", raised).withColumn("by_raise", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("raised"), "src_ord")))
    mode = F.when(F.col("named").isNotNull(), "named").when(F.col("matched") < min_sources, "prior").otherwise("share")
    rows = rows.withColumn("mode", mode).withColumn("best_other", best_other)
    kept = rows.filter(
        F.when(F.col("mode") == "named", is_named | F.col("best_other"))
        .when(F.col("mode") == "prior", F.col("by_raise") <= F.greatest(F.lit(min_sources), F.col("matched") + 1))
        .otherwise(F.col("score") > 0)
    )
    weight = F.when(F.col("mode") == "named", F.when(is_named, 0.8).otherwise(0.2)).when(F.col("mode") == "prior", F.col("raised") / F.sum("raised").over(q)).otherwise(F.col("score") / F.sum("score").over(q))
    kept = kept.withColumn("weight", weight)
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("weight"), "src_ord"))
    low_core = (F.col("mode") == "share") & F.col("anchored") & (F.col("src") == router.core) & (F.col("place") > 2)
    kept = kept.withColumn("place", place).withColumn("top", F.max("weight").over(q))
    kept = kept.withColumn("lifted", F.max(low_core.cast("int")).over(q) == 1).withColumn("weight", F.when(low_core, F.greatest("weight", F.col("top") * router.core_share)).otherwise(F.col("weight")))
    kept = kept.withColumn("weight", F.when(F.col("lifted"), F.col("weight") / F.sum("weight").over(q)).otherwise(F.col("weight")))
    position = F.when(F.col("mode") == "named", F.when(is_named, 1).otherwise(2)).when(F.col("mode") == "prior", F.col("by_raise")).otherwise(F.row_number().over(by_order))
    return kept.select(key, "src", "weight", position.cast("int").alias("route_pos"))


def budget(weights: DataFrame, total_k: int = 10, min_k: int = 1) -> DataFrame:
    """weights with k, the hits a source may give: its share of total_k rounded up, min_k at least."""
    return weights.withColumn("k", F.greatest(F.lit(min_k), F.ceil(F.lit(float(total_k)) * F.col("weight")).cast("int")))
