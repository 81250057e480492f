"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations alone.

Sources, in code-point order with null last, weigh as the given weights repeat, and share `budget_share` of all words; a
target stops at `max_epochs` times its source's words and the excess is shared again by weight (solved at once: sources
fill up in the order of their words by weight). Each source's documents are shuffled by a hash of their id and repeat in
epochs; a copy's virtual finish time is its source's words up to and with it divided by the source's target. All copies
are taken in order of finish time, ties by source, until the budget is spent.

Running sums are two-level so that no source, however large, meets in one task: each source is cut by its hash into
ranges, a range's sum is carried over from the totals before it; rows of one id and size are one counted row there, so a
hot id meets in no one task either. The budget's place in the global order is found from totals of bins of finish time;
only the bin in which it ends is looked into, again by bins while it is large, and put in exact order. What is taken is
range-sorted by finish time. A source's words differ from its target by less than one of its own documents and its share
of the one at which the budget ends.

Defined results: a null text has no words; null is a source like any other; documents without words are never taken and
a mix without words takes nothing; a null id is shuffled like the id 'null'; repeated rows are taken one by one.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import drop_staged, n_words, stage

WEIGHTS, MAX_EPOCHS, BUDGET_SHARE = (5, 2, 1), 3, 1.0
BINS, LEVELS, EDGE_ROWS, RANGE_ROWS, CHUNK = 1 << 16, 3, 1 << 20, 256, 1000
#: What rows are queued by; rows equal in all of it follow each other in any order.
KEY = ("source", "h", "doc_id", "size")


def id_hash(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id as text."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget_share: float = BUDGET_SHARE) -> DataFrame:
    """(source, ord, source_size, budget, target) from (source, source_size), a row a source."""
    order = Window.orderBy(F.col("source").isNull(), "source")  # a row a source
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("ord") - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("ord", F.row_number().over(order)).withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * max_epochs)
    every = Window.partitionBy(F.lit(0))
    rows = rows.withColumn("budget", F.floor(F.sum("source_size").over(every) * F.lit(budget_share)).cast("long"))
    fill = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "ord")
    used = F.coalesce(F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.col("budget") - used) / left).withColumn("full", F.col("most") / F.col("weight") < F.col("level")).withColumn("place", F.row_number().over(fill))
    level = F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), F.col("place"))).over(every)
    return rows.withColumn("target", F.coalesce(F.least(F.col("most").cast("double"), F.col("weight") * level), F.col("most").cast("double"))).select("source", "ord", "source_size", "budget", "target")


def _same(rows: DataFrame, other: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, (rows[c].eqNullSafe(other[c]) for c in KEY))


def _queue(narrow: DataFrame, weights: tuple[int, ...], max_epochs: int, budget_share: float) -> DataFrame:
    """A row a different (source, h, doc_id, size), staged: n rows, their source's ord, size, budget and target, and the
    words of the source that come before the first of them."""
    keys = stage(narrow.groupBy(*KEY).agg(F.count("*").alias("n")), "keys")
    rows = keys.count()
    bits = min(16, max(2, ceil(log2(max(rows, 1) / RANGE_ROWS)) if rows else 2))
    cell = F.shiftright("h", 60 - bits)
    cells = stage(keys.groupBy("source", cell.alias("cell")).agg(F.sum(F.col("size") * F.col("n")).alias("words")), "cells")
    goal = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs, budget_share).withColumnRenamed("source", "of")
    before = F.coalesce(F.sum("words").over(Window.partitionBy("ord").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = cells.join(goal, F.col("source").eqNullSafe(F.col("of"))).withColumn("before", before)
    ranges = stage(ranges.select(F.col("source").alias("of"), F.col("cell").alias("at"), "ord", "source_size", "budget", "target", "before"), "ranges")
    inside = Window.partitionBy("ord", "at").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0))
    queue = keys.join(ranges, F.col("source").eqNullSafe(F.col("of")) & (cell == F.col("at"))).select(*KEY, "n", "ord", "source_size", "budget", "target", start.alias("start"))
    queue = stage(queue, "queue")
    drop_staged(narrow.sparkSession, keys, cells, ranges)
    return queue


def _queued(rows: DataFrame, queue: DataFrame, *keep: str) -> DataFrame:
    """What is kept of rows (the KEY and more), size, ord, source_size, target, and `upto`: the words of the source up to and
    with each row. Equal rows are numbered part by part of a table of their own, so a hot id meets in no one task."""
    of = lambda some: rows.join(some, _same(rows, some)).select(*[rows[c] for c in dict.fromkeys((*KEY, *keep))], "n", "ord", "source_size", "target", "start")
    joined = of(queue.filter("n = 1"))
    many = stage(queue.filter("n > 1"), "many")  # a table of its own, so that rows are moved for it only where it is large
    repeats = stage(of(many).withColumn("part", F.spark_partition_id()), "repeats")
    by = [F.col(c) for c in (*KEY, "part")]
    counts = repeats.groupBy(*by).agg(F.count("*").alias("rows"))
    ahead = F.sum("rows").over(Window.partitionBy(*KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("ahead", F.coalesce(ahead, F.lit(0)))
    same = _same(repeats, counts) & (repeats["part"] == counts["part"])
    nth = F.row_number().over(Window.partitionBy(*[repeats[c] for c in (*KEY, "part")]).orderBy(repeats["ord"])) + F.col("ahead")
    numbered = repeats.join(counts, same).select(*[repeats[c] for c in joined.columns], nth.alias("nth"))
    every = joined.withColumn("nth", F.lit(1).cast("long")).unionByName(numbered)
    return every.withColumn("upto", F.col("start") + F.col("nth") * F.col("size")).select(*dict.fromkeys((*keep, "size", "ord", "source_size", "target", "upto")))


def _finish(epoch: Column | int) -> Column:
    return (F.col("upto") + (F.lit(epoch) if isinstance(epoch, int) else epoch) * F.col("source_size")) / F.col("target")


def _cut(queue: DataFrame, max_epochs: int) -> tuple[float, int] | None:
    """The finish time and source order of the last copy taken: the budget ends there. None where nothing is taken."""
    top = queue.select("budget").first()
    if top is None or not top.budget:
        return None
    full = queue.filter("size > 0")
    few = full.filter(F.col("n") <= CHUNK).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    many = full.filter(F.col("n") > CHUNK).withColumn("lo", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(CHUNK).cast("long")))).repartition("h", "lo")
    many = many.withColumn("i", F.explode(F.sequence("lo", F.least(F.col("lo") + CHUNK - 1, F.col("n"))))).drop("lo")
    rows = few.unionByName(many).withColumn("upto", F.col("start") + F.col("i") * F.col("size"))
    copies = rows.select("size", "ord", F.explode(F.array(*[_finish(e) for e in range(max_epochs)])).alias("finish"))
    live, low, scale, spent, cut = copies, 0.0, float(BINS), 0, None
    for _ in range(LEVELS):  # each level looks into the one bin in which the budget ends
        cell = F.least(F.floor((F.col("finish") - low) * scale), F.lit(2 * BINS))
        bins = live.groupBy(cell.alias("bin")).agg(F.sum("size").alias("words"), F.count("*").alias("copies"), F.max(F.struct("finish", "ord")).alias("last"))
        bins = stage(bins.withColumn("upto", F.sum("words").over(Window.orderBy("bin")) + spent), "bins")  # at most 2 * BINS + 1 rows
        whole = bins.filter(F.col("upto") <= top.budget).orderBy(F.desc("bin")).select("upto", "last").first()
        edge = bins.filter(F.col("upto") > top.budget).orderBy("bin").select("bin", "copies").first()
        spent, cut = (whole.upto, (whole.last.finish, whole.last.ord)) if whole else (spent, cut)
        if edge is None:
            return cut
        live, low, scale = live.filter(cell == edge.bin), low + edge.bin / scale, scale * BINS
        if edge.copies <= EDGE_ROWS:
            break
    end = F.sum("size").over(Window.orderBy("finish", "ord")) + F.lit(spent)
    last = live.withColumn("end", end).filter(F.col("end") <= top.budget).orderBy(F.desc("finish"), F.desc("ord")).select("finish", "ord").first()
    return cut if last is None else (last.finish, last.ord)


def plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...], max_epochs: int, budget_share: float) -> tuple[DataFrame, DataFrame, tuple[float, int] | None]:
    """The staged narrow rows, the queue and the cut."""
    narrow = stage(_narrow(docs, id_col, text_col, source_col), "sizes")
    queue = _queue(narrow, weights, max_epochs, budget_share)
    return narrow, queue, _cut(queue, max_epochs)


def _narrow(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    return docs.select(*more, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), id_hash(F.col(id_col)).alias("h"))


def _copies(cut: tuple[float, int] | None, max_epochs: int) -> Column:
    """How many copies of a queued row finish before the budget ends."""
    if cut is None:
        return F.lit(0)
    total = F.lit(0)
    for e in range(max_epochs):
        total += ((_finish(e) < F.lit(cut[0])) | ((_finish(e) == F.lit(cut[0])) & (F.col("ord") <= F.lit(cut[1])))).cast("int")
    return F.when(F.col("size") > 0, total).otherwise(0)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget_share: float = BUDGET_SHARE) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words that the mix takes, repeats counted)."""
    narrow, queue, cut = plan(docs, id_col, text_col, source_col, weights, max_epochs, budget_share)
    rows = _queued(narrow, queue, "doc_id")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * _copies(cut, max_epochs)).cast("long").alias("taken"))


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget_share: float = BUDGET_SHARE) -> DataFrame:
    """The mix itself: docs, all columns as they are, each row as often as it is taken, range-sorted by finish time."""
    narrow, queue, cut = plan(docs, id_col, text_col, source_col, weights, max_epochs, budget_share)
    if cut is None:
        return docs.limit(0)
    drop_staged(docs.sparkSession, narrow)
    queued = _queued(_narrow(docs, id_col, text_col, source_col, F.struct("*").alias("row")), queue, "row").withColumn("times", _copies(cut, max_epochs)).filter("times > 0")
    copies = queued.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    return copies.withColumn("finish", _finish(F.col("epoch"))).orderBy("finish", "ord").select("row.*")
