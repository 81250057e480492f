"""Incremental ingest: new rows of a vector table replace those of the same id, however files fall into micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparquill.sources.files import FOLDER, from_folders, in_folders, latest_rows, write_vectors

#: Where a row comes from, in the order in which rows replace each other.
VERSION = "row_version"


def follow(spark: SparkSession, folder: str, schema: str, table: str, checkpoint: str, key: str = "law_key", id_col: str = "id", once: bool = True, files_a_batch: int | None = None) -> StreamingQuery:
    """Reads JSON-lines files as they come. Each batch is appended as one folder of its own, named by its number, under the
    sources that it holds, and a batch that is run again writes the same folder, so a restart does no harm.

    Every row carries the time at which its file was modified, the file's path and its place in the file; of rows of one
    (source, id) the greatest of these counts, within a batch as between batches. So the result depends on the files alone:
    a file modified later replaces the rows of an earlier one, of files of the same time the one of the greater path, and in
    a file the later line."""

    def put(batch: DataFrame, number: int) -> None:
        place = F.struct(F.col("file.time").alias("time"), F.col("file.path").alias("path"), F.col("file.block").alias("block"), F.monotonically_increasing_id().alias("row"))
        rows = latest_rows(batch.withColumn(VERSION, place).drop("file"), [key, id_col], VERSION, keep=True)
        in_folders(rows, key).write.mode("overwrite").partitionBy(FOLDER).parquet(f"{table}/batch_no={number}")

    reader = spark.readStream.schema(schema)
    if files_a_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    at = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    stream = reader.json(folder).select("*", at.alias("file")).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if once else stream).start()


def read_latest(spark: SparkSession, table: str, sources: list[str] | None = None, key: str = "law_key", id_col: str = "id") -> DataFrame:
    """The rows of the table as they stand; only the named sources' folders are read, if any are named."""
    rows = from_folders(spark.read.option("basePath", table), f"{table}/batch_no=*", sources, key).drop("batch_no")
    return latest_rows(rows, [key, id_col], VERSION)


def compact(spark: SparkSession, table: str, path: str, key: str = "law_key", id_col: str = "id") -> None:
    """Writes the rows as they stand as a vector table of one folder a source."""
    write_vectors(read_latest(spark, table, None, key, id_col), path, key, id_col)
