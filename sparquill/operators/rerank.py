"""Rule boosts, anchor overlap and the choice of an expected hit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.functions.text import TOKEN, holds_any
from sparquill.operators import matching
from sparquill.plans.rules import Boosts


def query_terms(text: Column) -> Column:
    """The words of a text and its pairs of neighbouring words, lower-cased."""
    words = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, pairs))


def anchor_overlap(anchors: Column, terms: Column) -> Column:
    """How many anchors are among the terms, or have all their words among them."""
    return F.size(F.filter(anchors, lambda a: F.array_contains(terms, F.lower(a)) | (F.size(F.array_except(F.split(F.lower(a), " "), terms)) == 0)))


def rule_change(asked: Column, section: Column, moment: Column, rules: Boosts) -> Column:
    """The sum of all boosts and penalties whose terms the question holds and whose section (and moment, if given) fits."""
    change = F.lit(0.0)
    for terms, of, at, add in rules.boosts:
        fits = holds_any(asked, terms) & (section == of) & (F.lit(True) if at is None else moment == at)
        change += F.when(fits, F.lit(add)).otherwise(0.0)
    for terms, of, add in rules.penalties:
        change += F.when(holds_any(asked, terms) & (section == of), F.lit(add)).otherwise(0.0)
    return change


def table_change(hits: DataFrame, questions: DataFrame, rules: DataFrame, key: str = "question_id", text: str = "text", section: str = "section_id", moment: str = "moment") -> DataFrame:
    """hits with `change`, the sum of the rules that fit, for rules of a table (rule_id, term, section, moment, change): a row
    a term; a rule fits a hit if the question holds any of its terms, and its section and, unless null, its moment are the
    hit's. All terms are matched in one pass, and rules meet hits in a join, so neither plan nor work grows with rules that do not fire."""
    fired = questions.select(F.col(key), F.explode(matching.labels(F.lower(F.col(text)), rules, "term", "rule_id")).alias("rule_id"))
    effects = rules.select(F.col("rule_id").cast("string").alias("rule_id"), F.col("section").alias("of"), F.col("moment").alias("at"), F.col("change").cast("double").alias("each")).distinct()
    due = fired.join(effects, "rule_id").groupBy(key, "of", "at").agg(F.sum("each").alias("each"))
    own = F.lower(F.regexp_replace(F.col(section), " ", ""))
    found = hits.select(key, "rank", own.alias("of"), F.trim(F.col(moment)).alias("has")).join(due, [key, "of"]).filter(F.col("at").isNull() | (F.col("at") == F.col("has")))
    total = found.groupBy(key, "rank").agg(F.round(F.sum("each"), 9).alias("change"))
    return hits.join(total, [key, "rank"], "left").withColumn("change", F.coalesce("change", F.lit(0.0)))


def boost(hits: DataFrame, questions: DataFrame, rules: Boosts, key: str = "question_id", text: str = "text", section: str = "section_id", moment: str = "moment", anchors: str | None = "anchors") -> DataFrame:
    """hits (key, rank, score, section, moment, anchors) with score, boost_applied and rank anew. The whole change is held
    within cap_share of the score, the score does not fall below 0 and is rounded to four digits; ties keep their rank."""
    rows = hits.join(questions.select(F.col(key), F.lower(text).alias("asked")).hint("merge"), key)
    of = F.lower(F.regexp_replace(F.col(section), " ", ""))
    change = rule_change(F.col("asked"), of, F.trim(F.col(moment)), rules)
    if anchors and rules.overlap_terms:
        count = anchor_overlap(F.col(anchors), query_terms(F.col("asked")))
        active = holds_any(F.col("asked"), rules.overlap_terms) & of.isin(*rules.overlap_sections)
        change += F.when(active, F.least(F.lit(rules.overlap_unit) * count, F.lit(rules.overlap_most))).otherwise(0.0)
    most = F.col("score") * rules.cap_share
    rows = rows.withColumn("boost_applied", F.greatest(F.least(change, most), -most))
    rows = rows.withColumn("score", F.round(F.greatest(F.col("score") + F.col("boost_applied"), F.lit(0.0)), 4)).withColumn("boost_applied", F.round("boost_applied", 4))
    order = Window.partitionBy(key).orderBy(F.desc("score"), "rank")
    return rows.withColumn("rank", F.row_number().over(order)).drop("asked")


def boost_by_table(hits: DataFrame, questions: DataFrame, rules: DataFrame, cap_share: float = 0.2, key: str = "question_id", text: str = "text", section: str = "section_id", moment: str = "moment") -> DataFrame:
    """As boost(), by rules of a table."""
    rows = table_change(hits, questions, rules, key, text, section, moment)
    most = F.col("score") * cap_share
    rows = rows.withColumn("boost_applied", F.greatest(F.least(F.col("change"), most), -most)).drop("change")
    rows = rows.withColumn("score", F.round(F.greatest(F.col("score") + F.col("boost_applied"), F.lit(0.0)), 4)).withColumn("boost_applied", F.round("boost_applied", 4))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), "rank")))


def autofill(candidates: DataFrame, terms: str, text: str, anchors: str | None = None, key: str = "question_id", min_score: float = 0.45) -> DataFrame:
    """The best candidate of each question by (terms held by its text or anchors, score), both descending, then rank; status
    OK if it holds a term or its score reaches min_score, else FAIL."""
    low = F.lower(F.col(text))
    held = F.size(F.filter(F.col(terms), lambda t: F.contains(low, F.lower(t)) | (F.exists(F.col(anchors), lambda a: F.contains(F.lower(a), F.lower(t))) if anchors else F.lit(False))))
    best = Window.partitionBy(key).orderBy(F.desc("overlap"), F.desc("score"), "rank")
    rows = candidates.withColumn("overlap", held).withColumn("place", F.row_number().over(best)).filter("place = 1")
    return rows.withColumn("status", F.when((F.col("overlap") >= 1) | (F.col("score") >= min_score), "OK").otherwise("FAIL")).drop("place")
