"""Vectors in tasks: sound rows, matrices, exact integer products, blocks of a stated query set."""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import fresh_path, open_fs, read_file, stage

T = TypeVar("T")

#: Integer components beyond this raise: products of vectors of up to 1 024 of them fit a long a hundred times.
MOST = 1 << 23
#: Bytes of vectors that a task holds at a time, rows of a block of queries, bytes of blocks that a task keeps, and rows of
#: a chunk that meet a block at a time.
CHUNK_BYTES, BLOCK_ROWS, KEPT_BYTES, STEP = 16 << 20, 1024, 64 << 20, 2048


def sound(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column whose rows are of one length, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def integers(m: np.ndarray) -> np.ndarray:
    """floor(256 * x), exactly: a product by a power of two is not rounded."""
    scaled = np.floor(m * 256.0)
    if scaled.size and np.abs(scaled).max() > MOST:
        raise ValueError(f"a component beyond {MOST // 256} in size: products would not fit a long")
    return scaled.astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, exactly; in double precision where every partial sum is below 2^53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def by_length(table: pa.Table, column: str) -> Iterator[pa.Table]:
    """The rows of each length of vector apart."""
    n = pc.list_value_length(table[column])
    for length in pc.unique(n).to_pylist():
        yield table.filter(pc.equal(n, length))


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Tables of about `most` bytes, of a whole number of batches."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def write_blocks(queries: DataFrame, rows: int = BLOCK_ROWS) -> list[str]:
    """Writes a query set as Arrow files of at most `rows` rows in the shared folder, task by task; returns their names. A
    task that is run again writes files of other names, and only those of finished tasks are named."""
    spark = queries.sparkSession
    folder, queries = fresh_path(spark, "blocks"), stage(queries, "queries")
    parts = max(1, -(-queries.count() // rows))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        held, names = [b for b in batches if b.num_rows], []
        table = pa.Table.from_batches(held) if held else None
        for at in range(0, table.num_rows if table else 0, rows):
            name = f"{uuid.uuid4().hex}.arrow"
            with fs.open_output_stream(f"{root}/{name}") as out, pa.ipc.new_stream(out, table.schema) as stream:
                stream.write_table(table.slice(at, rows))
            names.append(f"{folder}/{name}")
        yield pa.RecordBatch.from_pydict({"path": pa.array(names, pa.string())})

    return sorted(r.path for r in queries.repartition(parts).mapInArrow(write, "path string").collect())


def read_block(path: str) -> pa.Table:
    return pa.ipc.open_stream(io.BytesIO(read_file(path))).read_all().combine_chunks()


def scan(rows: DataFrame, paths: list[str], ready: Callable[[pa.Table], T], meet: Callable[[T, T], pa.Table], schema: str, vector: str = "v", most: int = CHUNK_BYTES) -> DataFrame:
    """meet(block, chunk) for each block of a query set and each chunk of rows, both made ready, vectors of one length at a
    time. Rows are read once and stay where they are; a task keeps the blocks that fit in its memory and reads the others
    again for each chunk."""

    def made(table: pa.Table) -> dict[int, T]:
        return {pc.list_value_length(t[vector])[0].as_py(): ready(t) for t in by_length(table, vector)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, dict[int, T]] = {}
        room = KEPT_BYTES
        for chunk in chunks(batches, most):
            found = made(chunk)
            for path in paths:
                if path in kept:
                    asked = kept[path]
                else:
                    block = read_block(path)
                    asked = made(block)
                    if (room := room - 4 * block.nbytes) >= 0:
                        kept[path] = asked
                for length in asked.keys() & found.keys():
                    yield from meet(asked[length], found[length]).combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def steps(n: int, most: int = STEP) -> Iterator[slice]:
    """Slices of 64, 128, 256 rows and so on up to `most`, so that a threshold is there before most rows come."""
    at, size = 0, 64
    while at < n:
        yield slice(at, min(n, at + size))
        at, size = at + size, min(most, 2 * size)


def id_numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Ids as longs for ordering; null is the last."""
    return pc.fill_null(column, 2**63 - 1).to_numpy(zero_copy_only=False).astype(np.int64)


def best_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best entries of each group: by score, of equals by smaller id; entries of one id count once."""
    order = np.lexsort((-score, ids, group))
    first = np.ones(len(order), bool)
    first[1:] = (group[order][1:] != group[order][:-1]) | (ids[order][1:] != ids[order][:-1])
    order = order[first]
    order = order[np.lexsort((ids[order], -score[order], group[order]))]
    g = group[order]
    return order[np.arange(len(order)) - np.searchsorted(g, g) < k]
