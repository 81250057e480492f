"""Indexed vector search: an inverted file of k-means cells, of which a search reads the nearest to its questions only.

The centres are fitted by Spark's k-means on a bounded sample; every row of the corpus goes to the cell of the nearest one.
The index is a folder: `rows`, one folder a cell with the vectors themselves, a large cell in several files, and `centres`. A
question is held against the centres, goes to its `probes` nearest cells, and is scored there exactly, as search.topk
scores. A task reads rows of a cell and, from a table written by cell, the questions that probe it; rows of the index are
never shuffled, and cells that no question probes are not read.

The vectors stand in the cells in full. Codes of them would save reading only if the final scores came from elsewhere, and a
look-up of short lists by id would read the corpus again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparquill.blocks import chunks
from sparquill.operators.search import CHUNK_BYTES, best_columns
from sparquill.staging import fresh_path, stage

#: Cells by default, rows that the centres are fitted on, rows of a file of a cell, and how many cells there may be: their
#: centres and names go to all tasks.
CELLS, SAMPLE, FILE_ROWS, MOST_CELLS = 64, 65_536, 1 << 18, 1 << 16


def build(corpus: DataFrame, path: str, cells: int = CELLS, sample: int = SAMPLE, id_col: str = "id", vector: str = "embedding", file_rows: int = FILE_ROWS, seed: int = 7) -> None:
    """Writes the index of corpus under path. Rows without a vector are left out; at most `sample` rows are fitted."""
    if not 0 < cells <= MOST_CELLS:
        raise ValueError(f"between 1 and {MOST_CELLS} cells")
    rows = corpus.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).filter(F.col("v").isNotNull())
    centres = fitted(rows, cells, sample, seed)
    spark = corpus.sparkSession
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, v array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "v"))

    def to_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = (matrix(batch.column(1)) @ centres.T).argmax(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], ["id", "v", "cell"])

    placed = stage(rows.mapInArrow(to_cell, f"{kinds}, cell int"), "cells")
    placed.limit(0).write.mode("overwrite").parquet(f"{path}/schema")  # an empty index has no files to tell it
    files = placed.groupBy("cell").agg(F.ceil(F.count("*") / file_rows).alias("files"))  # a row a cell
    dealt = placed.join(F.broadcast(files), "cell").repartition("cell", F.pmod(F.xxhash64("id"), "files")).drop("files")
    dealt.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def fitted(rows: DataFrame, cells: int, sample: int, seed: int) -> np.ndarray:
    """Unit centres of the cells, at most as many as there are different vectors in the sample."""
    n = rows.count()
    if not n:
        return np.zeros((0, 0))
    low = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < F.lit(int(min(1.0, 0.9 * sample / n) * (1 << 40)))
    some = (rows if n <= sample else rows.filter(low).limit(sample)).select(array_to_vector("v").alias("features"))
    if some.isEmpty():
        some = rows.limit(sample).select(array_to_vector("v").alias("features"))
    found = np.array(KMeans(k=max(2, cells), seed=seed, maxIter=10).fit(some).clusterCenters()) if cells > 1 else np.zeros((1, len(rows.first().v)))
    length = np.linalg.norm(found, axis=1)[:, None]
    return np.divide(found, length, out=np.zeros_like(found), where=length > 0)


def centres_of(spark: SparkSession, path: str) -> np.ndarray:
    found = spark.read.schema("cell int, v array<double>").parquet(f"{path}/centres").orderBy("cell").collect()
    return np.array([r.v for r in found])


def probed(questions: DataFrame, centres: np.ndarray, probes: int, key: str, query_vector: str) -> DataFrame:
    """(key, q, cell): the nearest cells of each question that has a vector."""
    asked = questions.select(F.col(key).alias("key"), F.col(query_vector).alias("q")).filter(F.col("q").isNotNull())
    kinds = ", ".join(f"{c} {asked.schema[c].dataType.simpleString()}" for c in ("key", "q"))
    many = min(probes, len(centres))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and many:
                best = np.argsort(-(matrix(batch.column(1)) @ centres.T), axis=1, kind="stable")[:, :many]
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(np.repeat(np.arange(batch.num_rows), many))) for c in batch.columns), pa.array(best.ravel().astype(np.int32))], ["key", "q", "cell"])

    return asked.mapInArrow(run, f"{kinds}, cell int")


def indexed(spark: SparkSession, path: str) -> DataFrame:
    """(id, v, cell) of the rows of an index."""
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")


def search(questions: DataFrame, path: str, k: int, probes: int, key: str = "question_id", query_vector: str = "embedding", block: int = 4096) -> DataFrame:
    """(key, id, score, rank) as search.topk gives, of the rows in each question's `probes` nearest cells."""
    spark = questions.sparkSession
    wanted = probed(questions, centres_of(spark, path), probes, key, query_vector)
    kind = wanted.schema["key"].dataType.simpleString()
    folder = fresh_path(spark, "probes")
    wanted.repartition("cell", F.pmod(F.xxhash64("key"), F.lit(16))).write.option("maxRecordsPerFile", block).partitionBy("cell").parquet(folder)
    asked: dict[int, list[str]] = {}
    for file in sorted(spark.read.schema(wanted.schema).parquet(folder).inputFiles()):
        asked.setdefault(int(file.rsplit("cell=", 1)[1].split("/")[0]), []).append(file)
    rows = indexed(spark, path)
    rows = rows.filter(F.col("cell").isin(list(asked))).select("id", "v", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, CHUNK_BYTES):
            for cell in pc.unique(chunk["cell"]).to_pylist():
                own = chunk.filter(pc.equal(chunk["cell"], cell)).sort_by("id")  # so that equal scores keep the smaller ids
                v = matrix(own["v"])
                for file in asked[cell]:
                    fs, name = pafs.FileSystem.from_uri(file)
                    with fs.open_input_file(name) as source:
                        of = pq.ParquetFile(source).read(["key", "q"])
                    q = matrix(of["q"])
                    step = max(1, CHUNK_BYTES // (8 * len(v)))
                    for lo in range(0, len(q), step):
                        row, col, score = best_columns(np.round(q[lo : lo + step] @ v.T, 6), k)
                        yield pa.RecordBatch.from_arrays([pc.take(of["key"], pa.array(lo + row)).combine_chunks(), pc.take(own["id"], pa.array(col)).combine_chunks(), pa.array(score)], ["key", "id", "score"])

    found = rows.mapInArrow(run, f"key {kind}, id {rows.schema['id'].dataType.simpleString()}, score double")
    best = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(F.col("key").alias(key), "id", "score", "rank")


def recall(found: DataFrame, exact: DataFrame, key: str = "question_id") -> DataFrame:
    """(n_exact, n_found, recall): how many of the exact hits (key, id) were found."""
    hit = exact.select(key, "id").join(found.select(key, "id", F.lit(1).alias("hit")), [key, "id"], "left")
    return hit.agg(F.count("*").alias("n_exact"), F.count("hit").alias("n_found"), (F.count("hit") / F.count("*")).alias("recall"))


def rows_read(questions: DataFrame, path: str, probes: int, key: str = "question_id", query_vector: str = "embedding") -> DataFrame:
    """(key, n_rows, n_indexed): the rows that a question is scored against, and all of the index."""
    spark = questions.sparkSession
    sizes = indexed(spark, path).groupBy("cell").agg(F.count("*").alias("n"))
    every = sizes.agg(F.sum("n").alias("n_indexed"))
    per = probed(questions, centres_of(spark, path), probes, key, query_vector).join(sizes, "cell").groupBy(F.col("key").alias(key)).agg(F.sum("n").alias("n_rows"))
    return per.join(F.broadcast(every))
