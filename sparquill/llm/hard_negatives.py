"""Hard-negative mining by pruned inner products in an orthogonal PCA basis.

Rows are integer vectors with a label. An anchor's positives are the rows of its label with the greatest inner products; its
negatives for a positive are the greatest ones of other labels whose score lies between two shares of the positive's.

Both searches prune alike. Vectors are turned by an orthogonal matrix whose first columns are the principal components of a
bounded sample, so inner products stay the same while most of them gathers in the leading components. Products are added up a few
components at a time; what is missing is at most the product of the two remaining norms, plus slack for rounding. A pair whose sum
plus this bound is below what its anchor still asks for is dropped; the rest are multiplied out in integers, so results are
exact whatever the sample. What an anchor asks for rises while rows pass: the k-th best so far, or the window's lower end.

Anchors are a stated set, written as blocks that pass over chunks of rows; rows stay where they are, and only the best of
a chunk are shuffled, by anchor. No label is gathered anywhere, so a label may hold any share of the rows.

Defined results: rows with a null label or vector, or a null or non-finite component, take no part; vectors meet those of their
own length; rows of one id are one anchor, that of the smallest (label, vector), one positive and one negative, the best
of each; a null id is no anchor and the last among ties; an empty table gives no rows. Components beyond 32 768 in size raise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import bounded_sample, stage
from sparquill.llm.vectors import best_of, id_numbers, integers, matrix, scan, sound, steps, write_blocks

POSITIVES, NEGATIVES = 5, 3
#: The window of negatives in hundredths of the positive's score.
LOW, HIGH = 50, 95
#: Rows that the basis is fitted on; shares of the components after which pairs are dropped; pairs multiplied out at a time.
SAMPLE, CUTS, PAIRS = 4096, (1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8), 1 << 16
#: Below this share of pairs left they go on as a list, not as a matrix.
SPARSE = 1 / 16
NOTHING = -(2**62)


def prepared(df: DataFrame, label: Column, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, label, v) of the rows that take part."""
    rows = df.select(F.col(id_col).alias("id"), label.cast("string").alias("label"), F.col(vector).alias("v"))
    return rows.filter(F.col("label").isNotNull() & sound("v"))


def bases(rows: DataFrame, bound: int = SAMPLE) -> dict[int, np.ndarray]:
    """An orthogonal matrix for each length of vector of which the sample has at least as many rows: principal components in
    falling order. The driver gets `bound` rows at most."""
    sample = [np.array(r.v, np.float64) for r in bounded_sample(rows.select("id", "v"), "id", bound).select("v").collect()]
    out = {}
    for length in {len(v) for v in sample} - {0}:
        m = np.stack([v for v in sample if len(v) == length])
        if len(m) >= length:
            out[length] = np.linalg.eigh(m.T @ m)[1][:, ::-1]
    return out


class Pruned:
    """Integer vectors of a chunk or block with their ids and labels, their turned form, and the norms of what is left after
    each cut; of anchors that have positives, their scores too."""

    def __init__(self, table: pa.Table, bases: dict[int, np.ndarray]):
        self.ids, self.numbers, self.label = table["id"], id_numbers(table["id"]), table["label"]
        self.scores = table["scores"].to_pylist() if "scores" in table.column_names else []
        self.whole = integers(matrix(table["v"]))
        n = self.whole.shape[1]
        self.turned = self.whole.astype(np.float64) @ bases[n] if n in bases else self.whole.astype(np.float64)
        self.ends = sorted({max(1, round(n * c)) for c in CUTS if n} | {n})
        squares = self.turned**2
        self.left = np.stack([np.sqrt(squares[:, e:].sum(1)) for e in self.ends])
        self.size = np.sqrt(squares.sum(1))


def hopeful(a: Pruned, b: Pruned, part: slice, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b in `part`) whose product may reach `least` of a's row."""
    x, y = a.turned, b.turned[part]
    total = np.zeros(allowed.shape)
    alive, start, cut = allowed, 0, 0
    while cut < len(a.ends):
        end = a.ends[cut]
        total += x[:, start:end] @ y[:, start:end].T
        alive = alive & (total + np.outer(a.left[cut], b.left[cut, part]) + np.outer(a.size, 1e-10 * b.size[part]) >= least[:, None])
        start, cut = end, cut + 1
        if alive.mean() < SPARSE:
            break
    i, j = np.nonzero(alive)
    total = total[i, j]
    while cut < len(a.ends) and len(i):
        end = a.ends[cut]
        for lo in range(0, len(i), PAIRS):
            some = slice(lo, lo + PAIRS)
            total[some] += np.einsum("ij,ij->i", x[i[some], start:end], y[j[some], start:end])
        stay = total + a.left[cut, i] * b.left[cut, part][j] + 1e-10 * a.size[i] * b.size[part][j] >= least[i]
        i, j, total = i[stay], j[stay], total[stay]
        start, cut = end, cut + 1
    return i, j + part.start


def multiplied(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer products of pairs of rows."""
    out = np.zeros(len(i), np.int64)
    for lo in range(0, len(i), PAIRS):
        out[lo : lo + PAIRS] = (a[i[lo : lo + PAIRS]] * b[j[lo : lo + PAIRS]]).sum(1)
    return out


def label_numbers(block: Pruned, chunk: Pruned) -> tuple[np.ndarray, np.ndarray]:
    """Label numbers of both; a label of the chunk that the block has not is -1."""
    names = pc.unique(block.label)
    number = lambda t: pc.fill_null(pc.index_in(t.label, value_set=names), -1).to_numpy()
    return number(block), number(chunk)


def positives(rows: DataFrame, paths: list[str], basis: dict[int, np.ndarray], k: int = POSITIVES) -> DataFrame:
    """(anchor_id, place, positive_id, positive_score): the k best other rows of each anchor's label, place from 1."""
    kind = rows.schema["id"].dataType.simpleString()

    def meet(a: Pruned, b: Pruned) -> pa.Table:
        own, ids = a.numbers, b.numbers
        of, has = label_numbers(a, b)
        least = np.full(len(own), NOTHING, np.int64)
        group, at, score = (np.zeros(0, np.int64) for _ in range(3))
        for part in steps(len(ids)):
            i, j = hopeful(a, b, part, least, (of[:, None] == has[part]) & (own[:, None] != ids[part]))
            exact = multiplied(a.whole, b.whole, i, j)
            fair = exact >= least[i]
            group, at, score = np.concatenate([group, i[fair]]), np.concatenate([at, j[fair]]), np.concatenate([score, exact[fair]])
            best = best_of(group, score, ids[at], k)
            group, at, score = group[best], at[best], score[best]
            worst = np.full(len(own), 2**62, np.int64)
            np.minimum.at(worst, group, score)
            least = np.where(np.bincount(group, minlength=len(own)) == k, worst, NOTHING)
        return pa.Table.from_arrays([a.ids.take(pa.array(group)), b.ids.take(pa.array(at)), pa.array(score)], ["anchor_id", "positive_id", "positive_score"])

    found = scan(rows, paths, lambda t: Pruned(t, basis), meet, f"anchor_id {kind}, positive_id {kind}, positive_score long").repartition("anchor_id")
    once = found.groupBy("anchor_id", "positive_id").agg(F.max("positive_score").alias("positive_score"))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    return once.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select("anchor_id", "place", "positive_id", "positive_score")


def negatives(rows: DataFrame, paths: list[str], basis: dict[int, np.ndarray], k: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, place, rank, negative_id, negative_score) for blocks with each anchor's positive scores, by place: the k
    best rows of other labels with low * positive <= 100 * score <= high * positive."""
    kind = rows.schema["id"].dataType.simpleString()

    def meet(a: Pruned, b: Pruned) -> pa.Table:
        ids, scores = b.numbers, a.scores
        of, has = label_numbers(a, b)
        n, width = len(scores), max(map(len, scores))
        ends = np.full((2, n, width), 0, np.int64)
        ends[0] = 2**62  # no window where there is no positive
        for i, found in enumerate(scores):
            for p, s in enumerate(found):
                ends[:, i, p] = -(-low * s // 100), high * s // 100
        ends[0][ends[0] > ends[1]] = 2**62
        need = ends[0].copy()  # what a row must reach to enter each window's k best
        group, at, score = (np.zeros(0, np.int64) for _ in range(3))
        for part in steps(len(ids)):
            least = need.min(1)
            i, j = hopeful(a, b, part, least, (of[:, None] != has[part]) & (least < 2**62)[:, None])
            exact = multiplied(a.whole, b.whole, i, j)
            pair, p = np.nonzero((exact[:, None] >= need[i]) & (exact[:, None] <= ends[1][i]))
            group, at, score = np.concatenate([group, i[pair] * width + p]), np.concatenate([at, j[pair]]), np.concatenate([score, exact[pair]])
            best = best_of(group, score, ids[at], k)
            group, at, score = group[best], at[best], score[best]
            worst = np.full(n * width, 2**62, np.int64)
            np.minimum.at(worst, group, score)
            need = np.where(np.bincount(group, minlength=n * width) == k, worst, ends[0].ravel()).reshape(n, width)
        return pa.Table.from_arrays([a.ids.take(pa.array(group // width)), pa.array((group % width + 1).astype(np.int32)), b.ids.take(pa.array(at)), pa.array(score)], ["anchor_id", "place", "negative_id", "negative_score"])

    found = scan(rows, paths, lambda t: Pruned(t, basis), meet, f"anchor_id {kind}, place int, negative_id {kind}, negative_score long").repartition("anchor_id")
    once = found.groupBy("anchor_id", "place", "negative_id").agg(F.max("negative_score").alias("negative_score"))
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the prepared rows whose id is_anchor says."""
    basis = bases(rows)
    anchors = rows.filter(F.col("id").isNotNull() & is_anchor).groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select("id", "a.label", "a.v")
    anchors = stage(anchors, "anchors")
    near = stage(positives(rows, write_blocks(anchors), basis), "positives")
    scores = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    asked = anchors.join(scores, F.col("id") == F.col("anchor_id")).select("id", "label", "v", F.col("p.positive_score").alias("scores"))
    hard = negatives(rows, write_blocks(asked), basis)
    return hard.join(near, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
