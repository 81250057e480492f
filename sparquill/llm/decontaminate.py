"""Benchmark decontamination by winnowing.

Each benchmark item is cut into windows of `window` consecutive words (a shorter item is one window). Both sides are
fingerprinted by winnowing: of the k-gram hashes of a window the smallest (the rightmost of equals) is kept, so a span that
both sides share has a fingerprint chosen on both; for windows of fewer words than `k`, grams are the windows. Documents'
fingerprints are joined with the benchmark's; only documents with a hit go on, where each hit is extended both ways to all
windows around it, and these are joined with the benchmark's windows by 128-bit hashes of their words.

The benchmark's fingerprints and windows are tables, and Spark broadcasts them only if their measured size is small; else
the joins are shuffled by fingerprint, whose rows are one each on the benchmark's side. Texts of documents without a hit
are read once and never shuffled.

Defined results: a null or empty text has no words and is clean; null item ids hit words but are not listed; repeated
item ids count once; words are maximal runs of ASCII letters, digits and non-ASCII characters after lower-casing A-Z;
rows equal in id and text get the same result; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import drop_staged, slices, stage, text_bytes

WINDOW, K = 10, 5
#: A worker remembers the hashes of so many words, and takes texts in slices of so many bytes.
CACHE, SLICE = 100_000, 1 << 21
#: Bytes that are part of a word stay (A-Z as a-z); all others become a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = x = xxhash.xxh64_intdigest(word)
        return x


_HASHES = _Hashes()


def winnow(hashes: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Positions of the smallest (rightmost of equals) of the `width` hashes from each start on, each once; starts ascend."""
    best = starts + width - 1
    least = hashes[best]
    for j in range(width - 2, -1, -1):
        h = hashes[starts + j]
        less = h < least
        best, least = np.where(less, starts + j, best), np.where(less, h, least)
    return best[np.concatenate(([True], best[1:] != best[:-1]))] if len(best) else best


def prints(words: np.ndarray, bounds: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of windows of n words of several texts, and their positions: words holds a hash a word, the text i from
    bounds[i] to bounds[i + 1]. No window crosses a bound."""
    gram = min(k, n)
    sizes = np.maximum(np.diff(bounds) - n + 1, 0)
    starts = np.repeat(bounds[:-1] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    if not len(starts):
        return np.empty(0, np.uint64), starts
    h = np.zeros(len(words) - gram + 1, np.uint64)
    for j in range(gram):
        h = h * _MIX + words[j : j + len(h)]
    h ^= h >> np.uint64(31)
    at = winnow(h, starts, n - gram + 1)
    return h[at] + np.uint64(n * int(_ODD) % (1 << 64)), at


def windows(words: list[bytes], starts: list[int], n: int) -> np.ndarray:
    """A row of two 64-bit integers for the n words from each start on."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(words[s : s + n])) for s in starts), np.int64).reshape(-1, 2)


def hashed(texts: list[bytes | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words, their hashes one after another, and the bounds of each text in these."""
    words = [words_of(t) for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    return words, np.fromiter((_HASHES[w] for ws in words for w in ws), np.uint64, bounds[-1]), bounds


def benchmark_tables(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW, k: int = K) -> tuple[DataFrame, DataFrame]:
    """Staged (n, print), a row a fingerprint, and (n, a, b, item), a row a window and item."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, 1 << 20):
                for item, (words, hashes, bounds) in zip(batch.column(0).to_pylist(), map(lambda t: hashed([t]), text_bytes(batch.column(1))), strict=True):
                    n = min(window, len(words[0]))
                    if n:
                        found, size = prints(hashes, bounds, n, k)[0].view(np.int64), len(words[0]) - n + 1
                        both = windows(words[0], range(size), n)
                        lists = pa.ListArray.from_arrays(pa.array([0, *[len(found)] * size], pa.int32()), pa.array(found))
                        yield pa.RecordBatch.from_arrays([pa.array([n] * size, pa.int32()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array([item] * size, pa.string()), lists], ["n", "a", "b", "item", "prints"])

    rows = stage(items.mapInArrow(run, "n int, a long, b long, item string, prints array<long>"), "benchmark")
    made = stage(rows.select("n", F.explode("prints").alias("print")).distinct(), "prints"), stage(rows.select("n", "a", "b", "item").distinct(), "windows")
    drop_staged(benchmark.sparkSession, rows)
    return made


def fingerprinted(docs: DataFrame, lengths: list[int], id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """(doc_id, text_hash, n_words, prints) of every row: the fingerprints of windows of these lengths."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2, SLICE):
                _, hashes, bounds = hashed(text_bytes(batch.column(2)))
                found = [prints(hashes, bounds, n, k) for n in lengths] or [(np.empty(0, np.uint64), np.empty(0, np.int64))]
                values, at = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(at, kind="stable")
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(at[order], bounds).astype(np.int32)), pa.array(values[order].view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(bounds)), lists], ["doc_id", "text_hash", "n_words", "prints"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, n_words long, prints array<long>")


def window_lengths(known: DataFrame) -> list[int]:
    """The lengths of the benchmark's windows; at most `window` of them."""
    return sorted(r.n for r in known.select("n").distinct().collect())


def hit_windows(docs: DataFrame, marked: DataFrame, known: DataFrame, spans: DataFrame, lengths: list[int], id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Staged (doc_id, text_hash, n, start, a, b), a row a place of a document where a window of the benchmark stands."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    key = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long"

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2, SLICE):
                for ident, text_hash, text, hit in zip(*(batch.column(i).to_pylist() for i in range(2)), text_bytes(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                    words, hashes, bounds = hashed([text])
                    for n in lengths:
                        values, at = prints(hashes, bounds, n, k)
                        at = at[np.isin(values.view(np.int64), np.array(hit, np.int64))]
                        starts = np.unique((at[:, None] - np.arange(n - min(k, n) + 1)).ravel())
                        starts = starts[(starts >= 0) & (starts + n <= len(hashes))]
                        if len(starts):
                            both, m = windows(words[0], starts.tolist(), n), len(starts)
                            yield pa.RecordBatch.from_arrays([pa.array([ident] * m, batch.schema.field(0).type), pa.array([text_hash] * m, pa.int64()), pa.array([n] * m, pa.int32()), pa.array(starts), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["doc_id", "text_hash", "n", "start", "a", "b"])

    found_as = f"{key}, n int, start long, a long, b long"
    hits = marked.filter(F.size("prints") > 0).select("doc_id", "text_hash", F.explode("prints").alias("print")).join(known.select("print"), "print", "left_semi")
    hits = stage(hits.groupBy("doc_id", "text_hash").agg(F.collect_set("print").alias("hit")), "hits")
    of = hits.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"), "hit")
    texts = rows.join(of, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash"))).select("doc_id", "text_hash", "text", "hit")
    found = texts.mapInArrow(extended, found_as).join(spans.select("n", "a", "b").distinct(), ["n", "a", "b"], "left_semi")
    found = stage(found.select("doc_id", "text_hash", "n", "start", "a", "b"), "found")
    drop_staged(docs.sparkSession, hits)
    return found


def n_covered(spans: Column) -> Column:
    """How many words sorted (start, n) pairs cover."""
    step = lambda acc, s: F.struct((acc["total"] + F.greatest(s["start"] + s["n"] - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("total"), F.greatest(acc["end"], s["start"] + s["n"]).alias("end"))
    return F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end")), step)["total"]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated."""
    known, spans = benchmark_tables(benchmark, window=window, k=k)
    lengths = window_lengths(known)
    marked = stage(fingerprinted(docs, lengths, id_col, text_col, k), "marked")
    found = hit_windows(docs, marked, known, spans, lengths, id_col, text_col, k)
    hit = found.groupBy("doc_id", "text_hash").agg(n_covered(F.array_sort(F.collect_set(F.struct("start", "n")))).alias("n_hit"))
    named = found.select("doc_id", "text_hash", "n", "a", "b").distinct().join(spans, ["n", "a", "b"]).select("doc_id", "text_hash", "item").distinct()
    named = named.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list("item")).alias("items"))
    hit = hit.join(named.withColumnRenamed("doc_id", "d").withColumnRenamed("text_hash", "t"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")), "left")
    hit = stage(hit.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash"), "n_hit", "items"), "hit")
    drop_staged(docs.sparkSession, found, spans, known)
    joined = marked.drop("prints").join(hit, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """The rows of docs, all columns as they are, in which no benchmark window occurs."""
    known, spans = benchmark_tables(benchmark, window=window, k=k)
    lengths = window_lengths(known)
    found = hit_windows(docs, fingerprinted(docs, lengths, id_col, text_col, k), known, spans, lengths, id_col, text_col, k)
    bad = stage(found.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_hash")).distinct(), "contaminated")
    drop_staged(docs.sparkSession, found, spans, known)
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"))
    return rows.join(bad, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_hash")), "left_anti").select("row.*")
