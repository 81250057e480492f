"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is scaled to length one and turned by a random orthogonal matrix; the signs of its D components are its code, packed
into bytes. With s the signs over sqrt(D), the scalar fit = <s, u> says how well they stand for the turned vector u. The
inner product with a turned unit query q is estimated as <s, q> / fit; its error has the standard deviation
sqrt(1 - fit^2) / fit / sqrt(D - 1) at most over random rotations. What a query's estimate plus `eps` such deviations lifts over its k-th
best score so far is scored by its original vector, everything else is dropped; so the only losses are pairs whose error is
beyond eps deviations (eps = 3: about one in a thousand).

The index is a table of one row a vector (id, vector, code, fit), made where the rows are. A search writes its queries as blocks,
reads the index once, and a task passes each block over its codes; only the k best of a chunk are shuffled, by query.

Defined results: rows without a vector, of zeros alone or with a null or non-finite component take no part; vectors meet
those of their own length; rows of one id are one candidate, whose best score counts, and one query, that of the smallest
vector; a null id is a candidate, last among ties, and never the query's own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import stage
from sparquill.llm.vectors import best_of, by_length, id_numbers, matrix, scan, sound, steps, write_blocks

K, EPS, SEED = 5, 3.0, 20
#: Pairs that are scored at a time.
PAIRS = 1 << 18


@lru_cache(maxsize=4)
def rotation(length: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, length]).standard_normal((length, length)))
    return q * np.sign(np.diag(r))


def scaled(m: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that squares neither vanish nor overflow; cosines stay the same to the last bit."""
    return np.ldexp(m, -np.frexp(np.abs(m).max(1))[1][:, None])


def lengths(columns: np.ndarray) -> np.ndarray:
    """Lengths of the columns, summed in array order."""
    total = np.zeros(columns.shape[1])
    for x in columns:
        total += x * x
    return np.sqrt(total)


def turned(m: np.ndarray) -> np.ndarray:
    """Unit vectors of the rows, rotated."""
    m = scaled(m)
    return (m / np.sqrt((m * m).sum(1))[:, None]) @ rotation(m.shape[1])


def build(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The index (id, v, code, fit) of all rows that take part, as a table in the shared folder."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).filter(sound("v") & F.exists("v", lambda x: x != 0))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "v")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in by_length(pa.Table.from_batches([batch]), "v") if batch.num_rows else ():
                u = turned(matrix(rows["v"]))
                code = np.packbits(u > 0, axis=1)
                fit = np.abs(u).sum(1) / np.sqrt(u.shape[1])
                yield from rows.append_column("code", pa.array([c.tobytes() for c in code], pa.binary())).append_column("fit", pa.array(fit)).combine_chunks().to_batches()

    return stage(rows.mapInArrow(run, f"id {kinds[0]}, v {kinds[1]}, code binary, fit double"), "codes")


def estimates(code: np.ndarray, fit: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Estimated inner products of turned unit queries (rows) and coded vectors (columns)."""
    length = queries.shape[1]
    signs = np.unpackbits(code, axis=1, count=length).astype(np.float32) * 2 - 1
    return (queries.astype(np.float32) @ signs.T) / (np.sqrt(length) * fit).astype(np.float32)


def deviations(fit: np.ndarray, length: int) -> np.ndarray:
    """Standard deviation of each row's error, and slack for single precision."""
    return np.sqrt(np.maximum(0, 1 - fit * fit)) / fit / np.sqrt(max(1, length - 1)) + 1e-5


class Coded:
    """Vectors of a chunk or block: ids, columns scaled for scoring, lengths, and their codes or, of queries, turned forms."""

    def __init__(self, table: pa.Table):
        self.ids, self.numbers = table["id"], id_numbers(table["id"])
        plain = matrix(table["v"])
        self.columns = np.ascontiguousarray(scaled(plain).T)
        self.norms = lengths(self.columns)
        if "code" in table.column_names:
            self.code = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint8).reshape(len(plain), -1)
            self.fit = table["fit"].to_numpy()
            self.deviation = deviations(self.fit, plain.shape[1])
        else:
            self.turned = turned(plain)


def cosines(a: Coded, b: Coded, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of pairs, each summed in array order, so that equal vectors have equal scores."""
    total = np.zeros(len(i))
    for x, y in zip(a.columns, b.columns, strict=True):
        total += x[i] * y[j]
    return total / (a.norms[i] * b.norms[j])


def search(index: DataFrame, queries: DataFrame, k: int = K, eps: float = EPS, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): of each query the k nearest other rows of the index by cosine."""
    asked = queries.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).filter(sound("v") & F.exists("v", lambda x: x != 0))
    paths = write_blocks(asked.groupBy("id").agg(F.min("v").alias("v")))
    kinds = asked.schema["id"].dataType.simpleString(), index.schema["id"].dataType.simpleString()

    def meet(asked: Coded, has: Coded) -> pa.Table:
        n = len(asked.numbers)
        least = np.full(n, -np.inf)
        group, at, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for part in steps(len(has.numbers)):
            highest = estimates(has.code[part], has.fit[part], asked.turned) + eps * has.deviation[part]
            q, v = np.nonzero((highest >= least[:, None]) & (asked.numbers[:, None] != has.numbers[part]))
            v += part.start
            for lo in range(0, len(q), PAIRS):
                some_q, some_v = q[lo : lo + PAIRS], v[lo : lo + PAIRS]
                exact = cosines(asked, has, some_q, some_v)
                fair = exact >= least[some_q]
                group, at, score = np.concatenate([group, some_q[fair]]), np.concatenate([at, some_v[fair]]), np.concatenate([score, exact[fair]])
            best = best_of(group, score, has.numbers[at], k)
            group, at, score = group[best], at[best], score[best]
            worst = np.full(n, np.inf)
            np.minimum.at(worst, group, score)
            least = np.where(np.bincount(group, minlength=n) == k, worst, -np.inf)
        return pa.Table.from_arrays([asked.ids.take(pa.array(group)), has.ids.take(pa.array(at)), pa.array(score)], ["query_id", "vec_id", "score"])

    found = scan(index, paths, Coded, meet, f"query_id {kinds[0]}, vec_id {kinds[1]}, score double").repartition("query_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
