"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8, and what such links reach.

The near-duplicate operator's method, fingerprints, pigeonhole dealing, Gray-order hierarchical index and components, taken
over five-word shingles, with every link held against the shingle sets themselves.

Dealing. Shingles are cut by their hash into parts; a set's long fingerprint has one block a part, the SimHash of its shingles
there. Two sets of similarity 0.8 differ in at most a quarter of the shingles of either, and each such shingle changes one
block, so by the pigeonhole rule a set with more blocks than that shares one with every set it links to. More exactly: of all
blocks in one order for all sets, by number of shingles and part, the first n // 4 + 1 of each set have one in common, and a set of n
shingles goes to one group for each of these, keyed by the block's bits. The number of parts goes by the number of binary
digits of n; a set of 0.8 or more of the next power of two is dealt for the next number too. The few sets that fill too few
parts are dealt by each shingle besides. So dealing loses no link. A group of more than `GROUP` sets is cut into blocks.

Search. First a spanning step: in each group, or block of one, each set is paired with its `BEST` next neighbours in Gray
order (all, in a group of at most `SMALL` that is one block), and the links among these make components. Then groups of more,
whose members are of several components, are searched, each pair of blocks, by the Gray-order index over the sets' own
fingerprints: nodes whose members are all of one component are not followed into each other, all other pairs within `WIDE` bits are
candidates. Those go whose sizes or parities (for each of `WIDTH` bins whether the set has an odd number of shingles there; a
shingle that differs changes one of them at most) rule the similarity out; the rest are held against their sets, most of them
once: a row holds up to `HELD` of its set's groups, and a pair is left to the first that both hold. No candidate is capped,
and a dense group of copies, one component after the first step, makes no square of pairs.

Texts are read again for the blocks and for the sets of candidates; no table holds the sets of all documents.

Defined results: words are those of simhash; a text of fewer than five words is one shingle; texts without words are
copies of each other. Texts of equal sets are one set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import drop_staged, slices, stage, text_bytes, whole_groups
from sparquill.llm.components import connected_components
from sparquill.llm.simhash import GrayIndex, kept_rows

SHINGLE, SEED = 5, 42
#: Similarity of a link, as a fraction, and the most differing bits of a pair that the index finds. At similarity 0.8 fingerprints
#: differ in 9.7 bits (deviation 2.9), in more than 30 once in some 10^9 times, if bits are independent.
SIMILAR, WIDE = (4, 5), 30
#: Shingles a part in the largest sets of a number of parts, bins of parities, and buckets of a set that all its rows hold.
PART, WIDTH, HELD = 3, 512, 32
SMALL, BEST, GROUP, GROUP_BYTES = 4, 2, 2048, 32 << 20
#: Ids of sets of up to so many bytes are sent to all tasks, so that texts of other sets need not move; more are joined.
SENT_BYTES = 32 << 20
_U = np.uint64


def shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different shingles of a text."""
    words = text.lower().split() if text else []  # bytes.lower() changes A-Z alone
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    at, starts = 0, []
    for w in words:
        starts.append(at)
        at += len(w) + 1
    return np.unique(np.array([digest(joined[i : j - 1], SEED) for i, j in zip(starts, [*starts[width:], at], strict=False)], np.uint64))


def simhashes(hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The SimHash of each run of hashes, longest runs first: a bit is 1 if set in over half of the run."""
    out = [np.empty(0, _U)]
    for i in range(0, len(start), 4096):
        at, of = start[i : i + 4096], size[i : i + 4096]
        total = np.zeros((len(at), 64), np.int32)
        for j in range(int(of[0])):
            more = int(np.count_nonzero(of > j))  # runs of over j hashes
            total[:more] += np.unpackbits(hashes[at[:more] + j].view(np.uint8).reshape(-1, 8), axis=1)
        out.append(np.packbits(total * 2 > of[:, None], axis=1).view(_U)[:, 0])
    return np.concatenate(out)


def majority(hashes: np.ndarray) -> int:
    """The SimHash of a set: a bit is 1 if set in over half of the hashes."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        total += np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes)).view(np.int64)[0])


def parities(hashes: np.ndarray) -> bytes:
    """For each of WIDTH bins whether an odd number of the hashes is there."""
    return np.packbits(np.bincount((hashes % _U(WIDTH)).astype(np.int64), minlength=WIDTH) % 2 == 1).tobytes()


def _keys(code: np.ndarray, part: np.ndarray, size: np.ndarray, scheme: int) -> np.ndarray:
    x = code ^ (part.astype(_U) * _U(0x9E3779B97F4A7C15)) ^ (size.astype(_U) << _U(40)) ^ np.full(len(code), scheme, _U) << _U(56)
    x = (x ^ x >> _U(31)) * _U(0xBF58476D1CE4E5B9)
    return x ^ x >> _U(29)


def block_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of the groups of a set, of sorted hashes: two sets of similarity 0.8 or more have one in common."""
    n, found, few = len(hashes), [np.empty(0, _U)], False
    if n < SIMILAR[0]:  # such sets link to equal ones alone
        return found[0]
    digits, differ = n.bit_length(), n // 4  # differ: most shingles that are in one alone of the set and one that it links to
    for scheme in (digits, digits + 1) if n * SIMILAR[1] >= SIMILAR[0] << digits else (digits,):
        part = (hashes >> _U(32)) * _U((1 << scheme) // PART) >> _U(32)
        start = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        size = np.diff(np.append(start, n))
        few |= len(start) <= differ
        first = np.argsort(-size, kind="stable")[: differ + 1]
        start, size = start[first], size[first]
        found.append(_keys(simhashes(hashes, start, size), part[start], size, scheme))
    if few:
        found.append(_keys(hashes, np.zeros(n), np.zeros(n), 255))
    return np.concatenate(found)


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, key, check, n, fp, parity) of every row; key and check stand for the set, of n shingles."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    names = ["doc_id", "text_hash", "key", "check", "n", "fp", "parity"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2):
                keys, checks, sizes, codes, parity = [], [], [], [], []
                for text in text_bytes(batch.column(2)):
                    s = shingles(text)
                    keys.append(xxhash.xxh64_intdigest(s.tobytes()))
                    checks.append(xxhash.xxh64_intdigest(s.tobytes(), 1))
                    sizes.append(len(s))
                    codes.append(majority(s))
                    parity.append(parities(s))
                signed = [pa.array(np.array(x, _U).view(np.int64)) for x in (keys, checks)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *signed, pa.array(sizes, pa.int64()), pa.array(codes, pa.int64()), pa.array(parity, pa.binary())], names)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, key long, check long, n long, fp long, parity binary")


def may_link(x: np.ndarray, y: np.ndarray, n: np.ndarray, parity: np.ndarray) -> np.ndarray:
    """Whether pairs of positions are not ruled out by sizes or parities: sets of similarity p / q or more differ in at most
    (q - p) / (q + p) of the sum of their sizes, the sizes themselves among it."""
    p, q = SIMILAR
    most = (q - p) * (n[x] + n[y])
    at = np.flatnonzero((p + q) * np.abs(n[x] - n[y]) <= most)
    good = np.zeros(len(x), bool)
    good[at] = (p + q) * np.bitwise_count(parity[x[at]] ^ parity[y[at]]).sum(axis=1, dtype=np.int64) <= most[at]
    return good


def spanning_pairs(group: np.ndarray, codes: np.ndarray, n: np.ndarray, parity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of the first step, of rows sorted by group: neighbours among the leaves of the index."""
    order, size = GrayIndex(codes, group).order, np.bincount(group)
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for back in range(1, max(SMALL, BEST + 1)):
        x, y = order[:-back], order[back:]
        near = (group[x] == group[y]) & ((back <= BEST) | (size[group[x]] <= SMALL))
        x, y = x[near], y[near]
        near = may_link(x, y, n, parity)
        found.append((x[near], y[near]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def rest_pairs(group: np.ndarray, codes: np.ndarray, n: np.ndarray, parity: np.ndarray, label: np.ndarray, bucket: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of the exact step: those within a group, of different labels, that the index finds. A pair that
    has buckets in common among those held (0: none) is left to the least of them."""
    index = GrayIndex(codes, group)
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for a, b in index.pairs(WIDE, label):
        for i in range(0, len(a), 1 << 14):
            x, y = index.order[a[i : i + (1 << 14)]], index.order[b[i : i + (1 << 14)]]
            near = may_link(x, y, n, parity)
            x, y = x[near], y[near]
            common = np.where((held[x] == held[y]) & (held[x] != 0), held[x], np.iinfo(np.int64).max).min(axis=1)
            here = (common == bucket[x]) | (common == np.iinfo(np.int64).max)
            found.append((x[here], y[here]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _column(of: pa.ChunkedArray) -> np.ndarray:
    """A column as an array, a column of lists of one length as a matrix."""
    if not pa.types.is_list(of.type):
        return of.to_numpy()
    return np.concatenate([c.flatten().to_numpy() for c in of.chunks]).reshape(len(of), -1)


def _searched(rows: DataFrame, by: int, search: Callable[..., tuple[np.ndarray, np.ndarray]], *more: str) -> DataFrame:
    """Distinct pairs (a, b) of keys that search finds in rows (the group's `by` columns, key, fp, n, parity, more), a group whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, by):
            key, codes, n = table["key"].to_numpy(), table["fp"].to_numpy().view(_U), table["n"].to_numpy()
            parity = np.frombuffer(b"".join(table["parity"].to_pylist()), _U).reshape(len(key), -1)
            parts = np.stack([table.column(i).to_numpy() for i in range(by)])
            group = np.concatenate(([0], np.cumsum((parts[:, 1:] != parts[:, :-1]).any(axis=0))))
            a, b = search(group, codes, n, parity, *(_column(table[c]) for c in more))
            pairs = np.unique(np.sort(np.stack([key[a], key[b]]), axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    names = rows.columns[:by]
    return rows.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, "a long, b long").distinct()


def _block(*of: str) -> Column:
    return F.pmod(F.xxhash64(*of), F.col("blocks"))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    least, most = sorted((len(x), len(y)))
    if least * SIMILAR[1] < SIMILAR[0] * most:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * SIMILAR[1] >= SIMILAR[0] * (least + most - both)


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, text) of staged sets (key, of, of_hash), from all rows of their first document."""
    size = wanted.agg(F.sum(F.coalesce(F.octet_length(F.col("of").cast("string")), F.lit(0)) + 24)).first()[0] or 0
    few = F.broadcast(wanted) if size <= SENT_BYTES else wanted  # then no text moves but that of the sets
    return docs.join(few, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))).select("key", "text")


def shingle_sets(docs: DataFrame, sets: DataFrame, keys: DataFrame) -> DataFrame:
    """Staged (key, hashes) of some sets (key, place), read from the text of their first document."""
    keys = stage(keys.distinct(), "keys")  # a table, so that Spark knows its size before it moves any text
    wanted = stage(sets.join(keys, "key").select("key", F.col("place.doc_id").alias("of"), F.col("place.text_hash").alias("of_hash")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t).tobytes() for t in text_bytes(batch.column(1))], pa.binary())], ["key", "hashes"])

    made = stage(texts_of(docs, wanted).mapInArrow(run, "key long, hashes binary").groupBy("key").agg(F.first("hashes").alias("hashes")), "hashes")
    drop_staged(docs.sparkSession, keys, wanted)
    return made


def shared_blocks(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Staged (bucket, key): the groups of every set (key, place), but for groups of one set."""
    wanted = stage(sets.filter(F.col("n") >= SIMILAR[0]).select("key", F.col("place.doc_id").alias("of"), F.col("place.text_hash").alias("of_hash")), "wanted")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # so that equal rows go once from a task
        for whole in batches:
            for batch in slices(whole, 1):
                buckets, keys = [np.empty(0, _U)], []
                for key, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                    found = block_keys(shingles(text)) if key not in seen else buckets[0]
                    seen.add(key)
                    buckets.append(found)
                    keys.append(key)
                each = [len(b) for b in buckets[1:]]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(buckets).view(np.int64)), pa.array(np.repeat(np.array(keys, np.int64), each))], ["bucket", "key"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, before = np.empty((2, 0), np.int64), None  # the last row, which may have followers, and the bucket before it
        for batch in batches:
            rows = np.concatenate([rows, np.stack([batch.column(i).to_numpy() for i in range(2)])], axis=1)
            if not rows.shape[1]:
                continue
            rows = rows[:, np.concatenate(([True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)))]
            same = rows[0, 1:] == rows[0, :-1]
            paired = np.concatenate(([before is not None and rows[0, 0] == before], same))[:-1] | same
            yield pa.RecordBatch.from_arrays([pa.array(r[:-1][paired]) for r in rows], ["bucket", "key"])
            before = rows[0, -2] if rows.shape[1] > 1 else before
            rows = rows[:, -1:]
        if rows.shape[1] and before is not None and rows[0, 0] == before:
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["bucket", "key"])

    rows = texts_of(docs, wanted).mapInArrow(deal, "bucket long, key long").repartition("bucket").sortWithinPartitions("bucket", "key")
    made = stage(rows.mapInArrow(shared, "bucket long, key long"), "shared")
    drop_staged(docs.sparkSession, wanted)
    return made


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of staged pairs whose sets are similar enough."""
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("key"))
    known = shingle_sets(docs, sets, ends.select("key"))
    both = ends.join(known, "key").groupBy("a", "b").agg(F.collect_list("hashes").alias("sets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similar(*(np.frombuffer(h, np.uint64) for h in held)) for held in batch.column(2).to_pylist()]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    links = stage(both.mapInArrow(run, "a long, b long"), "links")
    drop_staged(docs.sparkSession, known)
    return links


def copy_roots(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, root) of every set: the components of links of similarity 0.8 or more. docs: (doc_id, text_hash, text); sets:
    staged (key, place, n, fp, parity)."""
    spark = docs.sparkSession
    dealt = shared_blocks(docs, sets)
    groups = dealt.join(sets.select("key", "n"), "key").groupBy("bucket").agg(F.count("*").alias("members"), F.sum("n").alias("total"))
    blocks = F.ceil(F.greatest(F.col("members") / GROUP, F.col("total") * 8 / GROUP_BYTES)).alias("blocks")
    groups = stage(groups.select("bucket", "members", blocks), "sizes")
    members = stage(dealt.join(groups, "bucket"), "members")
    drop_staged(spark, dealt, groups)

    known = sets.select("key", "fp", "n", "parity")
    rows = members.join(known, "key").select("bucket", _block("key", "bucket").alias("block"), "key", "fp", "n", "parity")
    pairs = stage(_searched(rows, 2, spanning_pairs), "pairs")
    roots = connected_components(verified(pairs, docs, sets))
    labels = stage(sets.select("key").join(roots, sets.key == roots.v, "left").select("key", F.coalesce("root", "key").alias("label")), "labels")

    large = stage(members.filter((F.col("members") > SMALL) | (F.col("blocks") > 1)).join(labels, "key"), "large")
    mixed = stage(large.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("bucket"), "mixed")
    rest = stage(large.join(mixed, "bucket", "left_semi"), "rest")
    drop_staged(spark, members, large, mixed)
    slots = [F.coalesce(F.min(F.when(F.pmod("bucket", F.lit(HELD)) == j, F.col("bucket"))), F.lit(0)) for j in range(HELD)]
    held = stage(rest.groupBy("key").agg(F.array(*slots).alias("held")).join(known, "key"), "held")
    dealt = rest.withColumn("mine", _block("key", "bucket")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.join(held, "key").select("bucket", F.least("mine", "other").alias("block"), F.greatest("mine", "other").alias("with"), "key", "fp", "n", "parity", "label", "held")
    pairs = stage(_searched(dealt, 3, rest_pairs, "label", "bucket", "held"), "more")
    links = verified(pairs, docs, sets)
    drop_staged(spark, rest, held)
    a, b = labels.select(F.col("key").alias("a"), F.col("label").alias("la")), labels.select(F.col("key").alias("b"), F.col("label").alias("lb"))
    again = connected_components(links.join(a, "a").join(b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))
    return labels.join(again, labels.label == again.v, "left").select("key", F.coalesce("root", "label").alias("root"))


def named_sets(rows: DataFrame) -> DataFrame:
    """Staged (key, place, n, fp, parity) of each different set of rows (doc_id, text_hash, key, check and so on), told
    apart by both hashes, 128 bits. Where unequal sets share a key, each takes its check as key."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = [F.first(c).alias(c) for c in rows.columns if c not in ("doc_id", "text_hash", "key", "check")]
    sets = stage(rows.groupBy("key", "check").agg(F.min(place).alias("place"), *first), "sets")
    twice = stage(sets.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1").select("key", F.lit(True).alias("twice")), "twice")
    if not twice.isEmpty():
        sets = stage(sets.join(twice, "key", "left").withColumn("key", F.when(F.col("twice"), F.col("check")).otherwise(F.col("key"))).drop("twice"), "sets")
    drop_staged(rows.sparkSession, twice)
    return sets.drop("check")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns as they are, with one row of each component: that of the smallest doc_id (null last), of the
    smallest text hash, and any one of rows equal in both."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    sets = named_sets(sketched(docs, id_col, text_col))
    rooted = sets.select("key", "place").join(copy_roots(texts, sets), "key")
    keep = stage(rooted.groupBy("root").agg(F.min("place").alias("key")), "keep")
    drop_staged(docs.sparkSession, sets)
    return kept_rows(docs, keep, id_col, text_col)
