"""SimHash near-duplicates: fingerprints of word shingles, linked at `distance` or fewer differing bits.

Search. Distinct fingerprints are dealt by the pigeonhole rule: cut into distance + 1 blocks of bits, two linked
fingerprints agree in one block at least, so each fingerprint goes to one group a block, keyed by the block's bits. A
group of more than `max_group` fingerprints is dealt again by blocks of its remaining bits, which is exact and, bits
being used up, ends in groups of bounded size whatever the data. Within a group a Gray-order hierarchical index is
searched: fingerprints sorted by Gray rank become leaves, upper nodes hold the bits that all below share (a mask and a
pattern), and pairs of nodes are followed downwards only while the differences of their shared bits stay within the
distance. Two nodes that cannot differ by more are linked as wholes, so a dense group of copies never makes all its
pairs; each group emits a tree of links per component, of at most three links a fingerprint.

Defined results: words are maximal runs of characters other than ASCII white space, A-Z lower-cased; a text of one or
two words is one shingle; a null, empty or blank text has fingerprint zero, which links like any other. A component's id
is its smallest doc_id (null only if all are null). Repeated rows share a fingerprint and so a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import slices, stage, text_bytes
from sparquill.llm.components import connected_components

SHINGLE, SEED, BITS, DISTANCE = 3, 42, 64, 3
MAX_GROUP, FAN = 8192, 8
_U = np.uint64
#: Most node pairs held at once while an index is searched.
FRONTIER = 1 << 14


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = text.lower().split() if text else []  # bytes.lower() changes A-Z alone
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined, digest, at, starts = b" ".join(words), xxhash.xxh64_intdigest, 0, []
        for w in words:
            starts.append(at)
            at += len(w) + 1
        hashes = [digest(joined[i : j - 1], SEED) for i, j in zip(starts, [*starts[shingle:], at], strict=False)]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    set_ = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(set_).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): fp holds the 64 bits as a bigint; text_hash tells rows of one id apart."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                fps = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column(2))], _U).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> _U(shift)
    return rank


class GrayIndex:
    """Hierarchical index over several groups of fingerprints at once; groups never share a node."""

    def __init__(self, codes: np.ndarray, group: np.ndarray) -> None:
        self.order = np.lexsort((gray_rank(codes), group))
        self.codes = codes[self.order]
        # A level: first child of each node (one more at the end), shared-bit mask and pattern. Level 0 has a node a fingerprint.
        first, mask, pattern, owner = np.arange(len(codes) + 1), np.full(len(codes), ~_U(0)), self.codes, group[self.order]
        self.levels = [(first, mask, pattern)]
        while len(owner) and (owner[1:] == owner[:-1]).any():
            change = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            offset = np.arange(len(owner)) - np.repeat(change, np.diff(np.append(change, len(owner))))
            start = np.flatnonzero(offset % FAN == 0)
            every, some = np.bitwise_and.reduceat(mask, start), pattern
            head = np.repeat(some[start], np.diff(np.append(start, len(owner))))
            every &= ~np.bitwise_or.reduceat(some ^ head, start)
            mask, pattern, owner = every, some[start] & every, owner[start]
            self.levels.append((np.append(start, len(head)), mask, pattern))

    def links(self, distance: int) -> Iterator[np.ndarray]:
        """Arrays (2, n) of linked positions of codes: a connected set of links for every set that is linked."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][1]))
        work = [(top, roots, roots)]
        while work:
            level, a, b = work.pop()
            if len(a) > FRONTIER:
                half = len(a) // 2
                work += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            _, mask, pattern = self.levels[level]
            shared = mask[a] & mask[b]
            differ = np.bitwise_count((pattern[a] ^ pattern[b]) & shared)
            near = differ <= distance
            if level == 0:
                near &= a != b
                yield np.stack([a[near], b[near]])
                continue
            sure = near & (differ + np.bitwise_count(~shared) <= distance)
            yield from self._whole(level, a[sure], b[sure])
            a, b = a[near & ~sure], b[near & ~sure]
            if len(a):
                work.append((level - 1, *self._children(level, a, b)))

    def pairs(self, distance: int, label: np.ndarray) -> Iterator[np.ndarray]:
        """Arrays (2, n) of positions of codes within the distance that have different labels. Nodes of one label in common
        are never followed into each other, so a group that is linked already costs a walk over its nodes."""
        low, high = [label[self.order]], [label[self.order]]
        for first, _, _ in self.levels[1:]:
            low.append(np.minimum.reduceat(low[-1], first[:-1]))
            high.append(np.maximum.reduceat(high[-1], first[:-1]))
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][1]))
        work = [(top, roots, roots)]
        while work:
            level, a, b = work.pop()
            if len(a) > FRONTIER:
                half = len(a) // 2
                work += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            _, mask, pattern = self.levels[level]
            near = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= distance
            near &= (np.minimum(low[level][a], low[level][b]) != np.maximum(high[level][a], high[level][b]))
            a, b = a[near], b[near]
            if level == 0:
                yield np.stack([a, b])
            elif len(a):
                work.append((level - 1, *self._children(level, a, b)))

    def _children(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = self.levels[level][0]
        na, nb = first[a + 1] - first[a], first[b + 1] - first[b]
        each = na * nb
        pair = np.repeat(np.arange(len(a)), each)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
        x, y = first[a][pair] + k // nb[pair], first[b][pair] + k % nb[pair]
        keep = x <= y
        return x[keep], y[keep]

    def _whole(self, level: int, a: np.ndarray, b: np.ndarray) -> Iterator[np.ndarray]:
        """Nodes whose fingerprints all link: each neighbour in order, and the two first ones."""
        lo, hi = self._span(level, a)
        lo_b, hi_b = self._span(level, b)
        yield np.stack([lo, lo_b])
        for start, end in ((lo, hi), (lo_b, hi_b)):
            n = np.maximum(end - start - 1, 0)
            at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield np.stack([at, at + 1])

    def _span(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = nodes, nodes + 1
        for k in range(level, 0, -1):
            lo, hi = self.levels[k][0][lo], self.levels[k][0][hi]
        return lo, hi


def forest(n: int, links: Iterator[np.ndarray]) -> np.ndarray:
    """Label of each of n positions: the smallest position that the links reach."""
    label = np.arange(n)
    for pairs in links:
        a, b = pairs
        while len(a):
            x, y = label[a], label[b]
            off = x != y
            if not off.any():
                break
            a, b, x, y = a[off], b[off], x[off], y[off]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def group_links(codes: np.ndarray, group: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links (codes, codes) that connect within each group what lies within the distance, as trees of degree three."""
    index = GrayIndex(codes, group)
    label = forest(len(codes), index.links(distance))
    order = np.argsort(label, kind="stable")
    ordered = label[order]
    start = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(order) else np.empty(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    child = rank > 0
    base = np.arange(len(order)) - rank
    return index.codes[order[child]], index.codes[order[(base + (rank - 1) // 2)[child]]]


def block_masks(mask: int, parts: int) -> list[int]:
    """`mask` with, in turn, each of `parts` blocks of the bits that it leaves free."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[len(free) * j // parts : len(free) * (j + 1) // parts]) for j in range(parts)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(codes: DataFrame, distance: int = DISTANCE, max_group: int = MAX_GROUP) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all that lie within the distance."""
    spark = codes.sparkSession
    masks, out = block_masks(0, distance + 1), None
    max_group = max(max_group, 2 ** (distance + 1))  # so that every block of a group to be dealt again has a bit
    keyed = codes.select("fp", F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("mask"))
    while True:
        keyed = keyed.withColumn("val", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = stage(keyed.groupBy("mask", "val").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")  # a table, so that a join on a hot group can be split
        grouped = stage(keyed.join(sizes, ["mask", "val"]), "groups")
        small, large = grouped.filter(F.col("n") <= max_group), grouped.filter(F.col("n") > max_group)
        found = stage(_search(small, distance), "links")
        out = found if out is None else out.union(found)
        masks = [r.mask & (1 << 64) - 1 for r in large.select("mask").distinct().collect()]  # at most (distance + 1) ** level of them
        if not masks:
            return out
        deeper = [(_signed(m), [_signed(x) for x in block_masks(m, distance + 1)]) for m in masks]
        plan = spark.createDataFrame(deeper, "mask long, next array<long>")
        keyed = large.select("fp", "mask").join(F.broadcast(plan), "mask").select("fp", F.explode("next").alias("mask")).distinct()


def _search(groups: DataFrame, distance: int) -> DataFrame:
    """Links within each (mask, val) group; groups come whole, in order, and are searched many at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
            if held:
                rows = np.concatenate([held.pop(), rows], axis=1)
            if not rows.shape[1]:
                continue
            last = int(np.flatnonzero((rows[:2] != rows[:2, -1:]).any(axis=0)).max(initial=-1)) + 1  # the last group may go on
            held.append(rows[:, last:])
            yield from found(rows[:, :last])
        for rows in held:
            yield from found(rows)

    def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if rows.shape[1]:
            new = np.concatenate(([True], (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)))
            a, b = group_links(rows[2].view(_U), np.cumsum(new), distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return groups.select("mask", "val", "fp").repartition("mask", "val").sortWithinPartitions("mask", "val").mapInArrow(run, "a long, b long")


def components(prints: DataFrame, distance: int = DISTANCE, max_group: int = MAX_GROUP) -> DataFrame:
    """(fp, root, component_id) for a staged table (doc_id, fp): the smallest doc_id that links reach from a fingerprint."""
    codes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "codes")
    roots = connected_components(near_links(codes.select("fp"), distance, max_group))
    joined = codes.join(roots, codes.fp == roots.v, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    joined = stage(joined, "rooted")
    least = stage(joined.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    return joined.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, max_group: int = MAX_GROUP) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle), "prints")
    return prints.join(components(prints, distance, max_group), "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, max_group: int = MAX_GROUP) -> DataFrame:
    """docs, all columns as they are, with one row of each component: that of the smallest doc_id (null last), of the
    smallest text hash, and any one of rows equal in both."""
    prints = stage(fingerprints(docs, id_col, text_col, shingle), "prints")
    ids = prints.join(components(prints, distance, max_group), "fp").select("root", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash").alias("key"))
    keep = ids.groupBy("root").agg(F.min("key").alias("key"))
    return kept_rows(docs, keep, id_col, text_col)


def kept_rows(docs: DataFrame, keep: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs, all columns as they are, where (id, text hash) is among keep.key; any one of rows equal in both. The key is
    plain, so that one shuffle serves the join and the choice among equal rows."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    keep = keep.select(name("key.doc_id").alias("own_id"), F.col("key.text_hash").alias("own_hash")).distinct()
    rows = docs.select(F.struct("*").alias("row"), name(id_col).alias("own_id"), F.xxhash64(text_col).alias("own_hash"))
    kept = rows.join(keep, ["own_id", "own_hash"], "left_semi")
    return kept.dropDuplicates(["own_id", "own_hash"]).select("row.*")
