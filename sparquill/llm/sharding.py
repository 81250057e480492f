"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a 60-bit hash of the document id. A bucket that holds more than the byte
limit splits on one more bit, the others stay, until every bucket fits. The directory is worked out from byte totals of
hash prefixes, a table of some entries a shard, never from rows; documents then look up their entry in one join, whose
keys are hashes and so even. Prefixes that are still too large at the directory's depth are worked out again with more
bits, by their own rows alone. Rows that share all bits (repeated ids) and exceed the limit go to pages of the bucket,
each of rows of one size, as many as fit.

Defined results: a document's bytes are its text's UTF-8 length (null: 0); a bucket of one row fits whatever its size; a
null id hashes like the id 'null'; repeated rows are placed one by one; an empty table has no shard and gives no file.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import stage
from sparquill.llm.mixing import id_hash

LIMIT_BYTES, HASH_BITS, MORE_BITS, SPARE_BITS = 64 << 20, 60, 8, 4


def directory(rows: DataFrame, done: int, depth: int, limit: int) -> DataFrame:
    """Entries (cell: the first `depth` bits) with their bucket: shard bits, local depth, bytes and rows; local_depth is
    null for entries that need more bits. Buckets of less than `done` bits were found too large before."""
    cells = stage(rows.groupBy(F.shiftright("h", HASH_BITS - depth).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs")), "cells")
    depths = F.explode(F.sequence(F.lit(done), F.lit(depth)))
    nodes = cells.select("cell", "bytes", "docs", depths.alias("at")).groupBy("at", F.expr(f"shiftright(cell, {depth} - at)").alias("prefix")).agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
    fits = stage(nodes.withColumn("fits", (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)), "nodes")
    above = fits.filter("not fits").select((F.col("at") + 1).alias("at"), "prefix")
    split = above.select("at", F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix"))
    leaves = fits.filter("fits").join(split, ["at", "prefix"], "left_semi").union(fits.filter(f"fits and at = {done}"))
    spread = leaves.select(F.explode(F.expr(f"sequence(shiftleft(prefix, {depth} - at), shiftleft(prefix + 1, {depth} - at) - 1)")).alias("cell"), F.expr("substring(lpad(bin(prefix), 64, '0'), 65 - at, at)").alias("shard"), F.col("at").alias("local_depth"), "shard_bytes", "shard_docs")
    return cells.select("cell").join(spread, "cell", "left")


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """shard, local_depth, shard_bytes and shard_docs of rows that share their whole hash: rows of one size, numbered part by
    part, as many to a page as fit."""
    rows = stage(rows.withColumn("part", F.spark_partition_id()), "overflow")
    key = ["h", "n_bytes"]
    totals = rows.groupBy(*key, "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*key, "part", F.coalesce(before, F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy(*key, "part").orderBy("n_bytes")) - 1 + F.col("before")
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))))
    paged = stage(rows.join(offsets, [*key, "part"]).withColumn("page", F.floor(number / each).cast("long")), "paged")
    full = paged.groupBy(*key, "page").agg(F.count("*").alias("page_docs"), F.sum("n_bytes").alias("page_bytes"))
    name = F.concat(F.expr(f"lpad(bin(h), {HASH_BITS}, '0')"), F.lit("-"), F.col("n_bytes").cast("string"), F.lit("-"), F.col("page").cast("string"))
    return paged.join(full, [*key, "page"]).withColumn("shard", name).withColumn("local_depth", F.lit(HASH_BITS)).withColumn("shard_bytes", F.col("page_bytes")).withColumn("shard_docs", F.col("page_docs")).drop("part", "before", "page", "page_docs", "page_bytes")


def directories(rows: DataFrame, limit: int) -> tuple[list[tuple[int, DataFrame]], bool]:
    """The (depth, staged directory) of each level for staged rows (n_bytes, h), and whether rows that share all bits are
    still too many."""
    total, done, out = rows.agg(F.sum("n_bytes")).first()[0] or 0, 0, []
    depth = min(HASH_BITS, max(1, ceil(log2(max(total / limit, 1))) + SPARE_BITS))
    while True:
        entries = stage(directory(rows, done, depth, limit), "directory")
        out.append((depth, entries))
        over = entries.filter("local_depth is null").select("cell")
        if over.isEmpty() or depth == HASH_BITS:
            return out, not over.isEmpty()
        rows = stage(rows.withColumn("cell", F.shiftright("h", HASH_BITS - depth)).join(over, "cell", "left_semi").select("n_bytes", "h"), "left")
        done, depth = depth + 1, min(HASH_BITS, depth + MORE_BITS)


def sized(docs: DataFrame, id_col: str, text_col: str, *keep: Column) -> DataFrame:
    return docs.select(*keep, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), id_hash(F.col(id_col)).alias("h"))


def placed(docs: DataFrame, id_col: str, text_col: str, limit: int, *keep: Column) -> DataFrame:
    """What is kept of every row, n_bytes and its shard, in one pass over docs; rows are carried, never looked up by id."""
    levels, over = directories(stage(sized(docs, id_col, text_col), "sizes"), limit)
    rows, found = sized(docs, id_col, text_col, *keep), ("shard", "local_depth", "shard_bytes", "shard_docs")
    for i, (depth, entries) in enumerate(levels):
        entries = entries.select(F.col("cell").alias("at"), F.struct(*found).alias(f"level{i}"))
        rows = rows.join(entries, F.shiftright("h", HASH_BITS - depth) == F.col("at"), "left").drop("at")
    of = lambda name: F.coalesce(*[F.when(F.col(f"level{i}.local_depth").isNotNull(), F.col(f"level{i}.{name}")) for i in range(len(levels))])
    rows = rows.select("*", *[of(name).alias(name) for name in found]).drop(*[f"level{i}" for i in range(len(levels))])
    if not over:
        return rows.drop("h")
    return rows.filter("local_depth is not null").unionByName(_paged(rows.filter("local_depth is null"), limit)).drop("h")


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, shard (its bucket's bits), local_depth, shard_bytes, shard_docs."""
    return placed(docs, id_col, text_col, limit, F.col(id_col).alias("doc_id")).select("doc_id", "n_bytes", "shard", "local_depth", "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES) -> str:
    """Writes docs, all columns as they are, as Parquet with a folder a shard, and returns the name of the column that the
    folders stand for: shard_bits, with underscores after it where docs has that one."""
    name = "shard_bits"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    rows = placed(docs, id_col, text_col, limit, F.struct("*").alias("row"))
    rows.select("row.*", F.concat(F.lit("s"), "shard").alias(name)).repartition(name).write.partitionBy(name).parquet(folder)
    return name
