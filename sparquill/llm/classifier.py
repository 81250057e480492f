"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

Features of a text are hashed into 2**BITS slots: each word without case and outer signs, each pair of such words, each
word's shape (runs of capitals, small letters, digits and the signs themselves, case kept), each pair of shapes, and for
each word whether it repeats the one before. A slot's value is its share of the text's features, times SCALE; the log
odds of the labels are added as a constant. Scoring is the sparse dot product with the weights, a gather and a mean.

Training reads labelled rows up to `bound` (a documented limit: those of the lowest hashes of their ids), in one task and in
hash order, so reruns agree; everything else scores every row, in one narrow scan.

Defined results: a null or empty text has the constant alone; repeated labels of an id count once, by their smallest,
and a repeated id is learnt from once, by the text of the smallest hash; rows without an id are scored and never held out; with no labels the score is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import bounded_sample, slices, text_bytes

BITS, BOUND, EPOCHS, SCALE, CUT = 18, 4_000, 2, 10.0, 0.7
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.5
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)
_SHAPE = re.compile(rb"[a-z]+|[A-Z]+|[0-9]+|(?:[\xc3-\xd4][\x80-\xbf])+|[\x80-\xff]+")
_RUN = re.compile(rb"(.)\1+")


class _Words(dict):
    """A word's surface and shape hashes, 32 bits each, in one integer."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        shape = _RUN.sub(rb"\1", _SHAPE.sub(lambda m: b"A" if m[0][0] < 91 and m[0][0] > 64 else b"0" if m[0][0] < 58 else b"a", word))
        surface = word.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~").lower() or word
        self[word] = x = (xxhash.xxh32_intdigest(surface) << 31 | xxhash.xxh32_intdigest(shape) >> 1) & (1 << 62) - 1
        return x


_WORDS = _Words()


def _slot(x: np.ndarray, space: int) -> np.ndarray:
    h = (x + np.uint64(space)) * _ODD
    h ^= h >> np.uint64(30)
    return (h * _MIX) >> np.uint64(64 - BITS)


def features(text: bytes | None) -> np.ndarray:
    """Slots of all features of a text, repeats included."""
    words = text.split() if text else []
    if not words:
        return np.empty(0, np.int64)
    v = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    surface, shape = v >> np.uint64(31), v & np.uint64((1 << 31) - 1)
    same = (v[1:] == v[:-1]).astype(np.uint64)
    parts = [_slot(surface, 1), _slot(surface[1:] + surface[:-1] * _MIX, 2), _slot(shape, 3), _slot(shape[1:] + shape[:-1] * _MIX, 4), _slot(same, 5)]
    return np.concatenate(parts).astype(np.int64)


def train(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the constant's last, after FTRL-proximal passes over (slots, label) rows in their order."""
    z, n, seen = np.zeros(1 << BITS), np.zeros(1 << BITS), []
    for slots, label in rows:
        at, times = np.unique(slots, return_counts=True)
        seen.append((at.astype(np.int32), (times * (SCALE / max(1, len(slots)))).astype(np.float32), label))
    good = sum(label for _, label in rows)
    constant = np.log((good + 1) / (len(rows) - good + 1))
    for _ in range(epochs):
        for at, x, label in seen:
            w = _weights(z[at], n[at])
            g = (1 / (1 + np.exp(-np.clip(constant + w @ x, -35, 35))) - label) * x
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w
    return np.append(_weights(z, n), constant).astype(np.float32)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def scores(texts: list[bytes | None], weights: np.ndarray) -> np.ndarray:
    out = np.full(len(texts), float(weights[-1]))
    for i, text in enumerate(texts):
        slots = features(text)
        if len(slots):
            out[i] += SCALE * float(weights[slots].mean(dtype=np.float64))
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", bound: int = BOUND) -> np.ndarray:
    """Weights learnt from at most `bound` of the labelled rows."""
    one = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().groupBy("id").agg(F.min("label").alias("label"))
    sample = bounded_sample(one, "id", bound)  # of bounded size, so it may be broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    first = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))  # a row a sampled id, however often it is repeated
    texts = texts.groupBy("id", "label").agg(first.alias("t")).select("t.text", "label", F.xxhash64("id").alias("turn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(features(t), y) for b in batches for t, y in zip(text_bytes(b.column(0)), b.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_pydict({"weights": [train(rows).tobytes()]})

    fitted = texts.repartition(1).sortWithinPartitions("turn", "text").mapInArrow(run, "weights binary").collect()
    return np.frombuffer(bytes(fitted[0].weights), np.float32) if fitted else np.zeros((1 << BITS) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """(doc_id, score, predicted) of every row; the weights are of fixed size."""
    held = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                p = scores(text_bytes(batch.column(1)), held.value)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= cut).astype(np.int32))], ["doc_id", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
