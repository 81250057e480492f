"""Stated sets of rows (questions, rules) as files of bounded size in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame

from sparquill.staging import fresh_path, stage


def write_blocks(rows: DataFrame, most: int, by: str | None = None, name: str = "blocks") -> list[str]:
    """Writes rows as Arrow files of at most `most` rows; returns their names. Those of one `by` lie together."""
    folder, rows = fresh_path(rows.sparkSession, name), stage(rows, name)
    parts = max(1, -(-rows.count() // most))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names = [], []
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)

        def flush(rows: pa.Table) -> None:
            name = uuid.uuid4().hex  # only files of finished tasks are named in the result
            with fs.open_output_stream(f"{root}/{name}.arrow") as out, pa.ipc.new_stream(out, rows.schema) as stream:
                stream.write_table(rows)
            names.append(f"{folder}/{name}.arrow")

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= most:
                rows = pa.Table.from_batches(held)
                flush(rows.slice(0, most))
                held = rows.slice(most).to_batches()
        if sum(b.num_rows for b in held):
            flush(pa.Table.from_batches(held))
        yield pa.RecordBatch.from_pydict({"path": pa.array(names, pa.string())})

    dealt = rows.repartition(parts, by) if by else rows.repartition(parts)
    return sorted(r.path for r in dealt.mapInArrow(write, "path string").collect())


def read_block(path: str) -> pa.Table:
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(name) as stream:
        return pa.ipc.open_stream(stream).read_all().combine_chunks()


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Tables of at least `most` bytes, of whole batches; the last may be smaller."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.nbytes for b in held) >= most:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)
