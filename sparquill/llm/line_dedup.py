"""Line deduplication by winnowing over line hashes, in DataFrame operations alone.

Every run of `run` lines that also stands earlier in the corpus goes, and so every longer repeated run; and so does a single
line of `long_words` words or more, a passage of its own. Of each `run` consecutive line hashes of a document the smallest
(the rightmost of equals) is a fingerprint, so two equal runs share one at the same place; each long line is one too.
Fingerprints found at one position only are dropped by a semi join; the others are extended both ways to the runs
around them, equal runs are brought together by 128 bits (two hashes of each line by different seeds, hashed over the run), and
all but the first in corpus order (doc_id, null last, then text hash; then position) are deleted. First places are minima aggregated before the shuffle: no pairs are made, and
a run that very many documents share costs one row each.

Defined results: a null text has no lines; an empty text is one empty line; documents of fewer than `run` lines lose long
lines alone; rows equal in id and text are one document and get the same result; a document may lose all its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import n_words, stage

RUN, LONG_WORDS = 2, 50


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(line: Column) -> tuple[Column, Column]:
    """Two hashes of a line that collide independently."""
    return F.xxhash64(line), F.xxhash64(F.lit(1), line)


def winnowed(hashes: str, run: int) -> Column:
    """0-based positions of the smallest hash (rightmost of equals) of every `run` consecutive ones."""
    return F.expr(
        f"""array_distinct(transform(sequence(1, size({hashes}) - {run} + 1), i ->
        i + {run} - 1 - array_position(reverse(slice({hashes}, i, {run})), array_min(slice({hashes}, i, {run})))))"""
    )


def fingerprints(docs: DataFrame, id_col: str, text_col: str, run: int, long_words: int) -> DataFrame:
    """(doc_id, text_hash, n, pos, print, from, runs): n lines make a run; runs are the hash pairs of all runs over pos."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), lines_of(F.col(text_col)).alias("lines"))
    wordy = lambda line: (F.length(line) >= 2 * long_words - 1) & (n_words(line) >= long_words)
    own = F.filter(F.transform("lines", lambda line, i: F.when(wordy(line), i)), lambda i: i.isNotNull()) if run > 1 else F.array().cast("array<int>")
    first, second = F.transform("lines", lambda line: line_hashes(line)[0]), F.transform("lines", lambda line: line_hashes(line)[1])
    rows = rows.select("doc_id", "text_hash", first.alias("h"), second.alias("g"), own.alias("own"))
    none = F.array().cast("array<struct<n:int,pos:int>>")
    runs = F.when(F.size("h") >= run, F.transform(winnowed("h", run), lambda p: F.struct(F.lit(run).alias("n"), p.cast("int").alias("pos")))).otherwise(none)
    picks = F.concat(runs, F.transform("own", lambda p: F.struct(F.lit(1).alias("n"), p.cast("int").alias("pos"))))
    picked = rows.select("doc_id", "text_hash", "h", "g", F.explode(picks).alias("p")).select("doc_id", "text_hash", "h", "g", "p.*")
    start, last = F.greatest(F.col("pos") - F.col("n") + 1, F.lit(0)), F.least(F.col("pos"), F.size("h") - F.col("n"))
    over = F.transform(F.sequence(start, last), lambda i: F.struct(F.xxhash64(F.slice("h", i + 1, F.col("n"))).alias("a"), F.xxhash64(F.slice("g", i + 1, F.col("n"))).alias("b")))
    return picked.select("doc_id", "text_hash", "n", "pos", F.get("h", F.col("pos")).alias("print"), start.alias("from"), over.alias("runs"))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, long_words: int = LONG_WORDS) -> DataFrame:
    """(doc_id, text_hash, spans): the spans of lines to delete, as sorted (first, end) pairs of 0-based positions."""
    prints = stage(fingerprints(docs, id_col, text_col, run, long_words).distinct(), "prints")
    shared = prints.groupBy("n", "print").agg(F.count("*").alias("times")).filter("times > 1").select("n", "print")
    shared = stage(shared, "shared")  # as a table of its own, so that a join on a hot print can be split
    found = prints.join(shared, ["n", "print"], "left_semi")
    runs = found.select("doc_id", "text_hash", "n", "from", F.posexplode("runs").alias("k", "r"))
    runs = runs.select("doc_id", "text_hash", "n", (F.col("from") + F.col("k")).alias("at"), "r.a", "r.b")
    runs = stage(runs.distinct(), "runs")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "at")
    first = runs.groupBy("n", "a", "b").agg(F.min(place).alias("first"), F.count("*").alias("times")).filter("times > 1").drop("times")
    first = stage(first, "first")
    later = runs.join(first, ["n", "a", "b"]).filter(~place.eqNullSafe(F.col("first"))).select("doc_id", "text_hash", "at", (F.col("at") + F.col("n")).alias("end"))
    order = Window.partitionBy("doc_id", "text_hash").orderBy("at", "end")
    new = F.coalesce((F.col("at") > F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    spans = later.withColumn("new", new).withColumn("span", F.sum("new").over(order)).groupBy("doc_id", "text_hash", "span").agg(F.struct(F.min("at").alias("first"), F.max("end").alias("end")).alias("s"))
    return spans.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("s")).alias("spans"))


def without(lines: str, spans: str) -> Column:
    """The lines outside the spans."""
    return F.expr(
        f"""flatten(transform(sequence(0, size({spans})), j -> slice({lines},
        if(j = 0, 0, {spans}[j - 1].end) + 1, if(j = size({spans}), size({lines}), {spans}[j].first) - if(j = 0, 0, {spans}[j - 1].end))))"""
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, long_words: int = LONG_WORDS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, text without the repeated runs."""
    spans = repeated_runs(docs, id_col, text_col, run, long_words).withColumnRenamed("doc_id", "of").withColumnRenamed("text_hash", "of_hash")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    joined = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash")), "left")
    kept = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(without("lines", "spans"), "\n"))
    gone = F.coalesce(F.expr("aggregate(spans, 0L, (n, s) -> n + cast(s.end - s.first as bigint))"), F.lit(0))
    lined = joined.withColumn("lines", lines_of(F.col("text")))
    return lined.select("doc_id", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"), gone.cast("long").alias("n_removed"), kept.alias("text"))
