"""Shared helpers: files written by tasks, text columns as bytes, groups of rows in tasks, bounded samples."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.staging import drop_staged, fresh_path, shared_dir, stage  # noqa: F401  the operators take them from here

#: A maximal run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, data: bytes) -> None:
    """Writes a whole file under a temporary name and renames it, so a retried task leaves no torn file."""
    fs, path = open_fs(uri)
    folder = path.rsplit("/", 1)[0]
    fs.create_dir(folder, recursive=True)
    part = f"{folder}/.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        out.write(data)
    fs.move(part, path)


def read_file(uri: str) -> bytes:
    fs, path = open_fs(uri)
    with fs.open_input_stream(path) as f:
        return f.read()


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 23) -> list[pa.RecordBatch]:
    """Cuts a record batch so that each piece holds about `most` bytes of the given text column."""
    out, start, total = [], 0, 0
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            out.append(batch.slice(start, i + 1 - start))
            start, total = i + 1, 0
    if start < batch.num_rows:
        out.append(batch.slice(start))
    return out


def whole_groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[pa.Table]:
    """Tables of whole groups, of rows sorted by their first `by` columns; at most a batch and a group at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.array([False] * batch.num_rows)
        for c in range(by):
            new = pc.or_(new, pc.fill_null(pc.not_equal(batch.column(c), batch.column(c)[batch.num_rows - 1]), False))
        last = pc.sum(pc.cast(new, pa.int64())).as_py() or 0  # rows of the groups before the last, which may go on
        if held and any(held[-1].column(c)[held[-1].num_rows - 1] != batch.column(c)[0] for c in range(by)):
            yield pa.Table.from_batches(held)
            held = []
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def row_key(column: str) -> list[Column]:
    """Two plain columns that tell a null from any value, for joins and groups by an id that may be null."""
    return [F.col(column).isNull(), F.coalesce(F.col(column).cast("string"), F.lit(""))]


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(df: DataFrame, id_col: str, bound: int) -> DataFrame:
    """df where it has at most `bound` rows; else the rows whose id's hash is among the lowest, about nine tenths of the
    bound and never more than it. What each task passes on shrinks with the share, so nothing large meets in one place."""
    rows = df.count()
    if rows <= bound:
        return df
    low = F.pmod(F.xxhash64(id_col), F.lit(1 << 40)) < F.lit(int(0.9 * bound / rows * (1 << 40)))
    return df.filter(low).limit(bound)
