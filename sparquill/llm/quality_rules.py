"""Quality rules: fixed base rules, then a decision list learnt by sequential covering.

Statistics of every whole text are computed once. From labelled rows that pass the base rules, the learner grows one
conjunction of thresholds at a time on two thirds of the rows (the literal of highest information gain next), prunes it
on the other third (final literals go while that does not lower its worth), and keeps it if it is pure enough; rows that
it covers go, and the next one is grown. The list becomes one ordered conditional expression of Spark columns.

The learner reads the documents of at most `bound` labelled ids (those of the lowest hashes of all labelled ids; a
documented limit), whether it judges or filters; the rules apply to all rows. Covering ends by purity, cover and gain
alone: each rule takes away at least `MIN_COVER` rows, each literal some.

Defined results: a null text has no words and fails the base; lines and words are compared byte for byte; a null or
repeated label counts once, by its smallest value, and a repeated id is learnt from once, by its smallest counts; with no
labels or no pure rule every row that passes the base is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import bounded_sample, slices, stage

SYMBOLS, SPACE = "#*$%&|<>", "\t\n\x0b\x0c\r "
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 50, 50, 3
BOUND, CUTS = 20_000, 24
#: Least purity of a rule among the rows held for pruning, smoothed, least rows that it covers, and least bad ones of those held.
MIN_PURITY, MIN_COVER, MIN_HELD = 0.95, 8, 2
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_digits", "n_distinct", "n_lines", "n_chars", "n_same")
_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))


def statistics(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    spaces = sum(map(text.count, SPACE))
    seen: dict[bytes, int] = {}
    fresh = count().__next__
    ids = np.fromiter((seen[w] if w in seen else seen.setdefault(w, fresh()) for w in words), np.int64, n)
    same = int((ids[1:] == ids[:-1]).sum())
    return (
        n, len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(ids, REPEAT_WINDOW),
        len(raw) - len(raw.translate(None, _UPPER)), sum(map(text.count, "!?;:=_~^@")), len(raw) - len(raw.translate(None, _DIGIT)),
        len(seen), len(lines), len(text), same,
    )


def repeated_words(ids: np.ndarray, width: int) -> int:
    """Words that lie in a window of `width` ids that is found at least twice."""
    if len(ids) <= width:
        return 0
    key = ids[: len(ids) - width + 1]
    for j in range(1, width):
        key = key * (int(ids.max()) + 1) + ids[j : len(ids) - width + 1 + j]
        if int(key.max()) > 1 << 40:
            key = np.unique(key, return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    equal = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[: len(key)] += twice
    edge[width:] -= twice
    return int((np.cumsum(edge) > 0).sum())


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the COUNTS) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                table = np.array([statistics(t) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(COUNTS))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(table[:, j]) for j in range(len(COUNTS)))], ["doc_id", *COUNTS])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < MIN_WORDS) | (F.lit(100) * n_repeat > F.lit(MAX_REPEAT_PERCENT) * n_words)


def ratios(c, over) -> dict[str, object]:
    """The learner's variables: c gives a count by name, over divides two of them, as columns or as arrays."""
    return {
        "words": c("n_words") * 1.0, "word_length": over(c("word_chars"), c("n_words")), "symbols": over(c("n_symbols"), c("n_words")), "dup_lines": over(c("n_dup_lines"), c("n_lines")),
        "repeats": over(c("n_repeat_words"), c("n_words")), "upper": over(c("n_upper"), c("n_chars")), "marks": over(c("n_marks"), c("n_words")), "digits": over(c("n_digits"), c("n_chars")),
        "distinct": over(c("n_distinct"), c("n_words")), "same": over(c("n_same"), c("n_words")),
    }


Rule = list[tuple[str, bool, float]]  # variable, above?, threshold


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for name, above, cut in rule:
        hit &= x[name] > cut if above else x[name] <= cut
    return hit


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    """Information gain of covering p and n where p0 and n0 were covered."""
    return p * (np.log2((p + 1) / (p + n + 2)) - np.log2((p0 + 1) / (p0 + n0 + 2)))


def grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = []
    inside = np.ones(len(bad), bool)
    while inside.any() and not bad[inside].all():
        p0, n0, best = int(bad[inside].sum()), int((~bad[inside]).sum()), (1e-9, None)
        for name, values in x.items():
            v, y = values[inside], bad[inside]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, CUTS + 1)[1:-1]))
            cuts = np.unique(np.concatenate((cuts, np.quantile(v[y], np.linspace(0, 1, 9)) - 1e-9))) if y.any() else cuts
            order = np.argsort(v, kind="stable")
            below = np.searchsorted(v[order], cuts, side="right")
            bads = np.concatenate(([0], np.cumsum(y[order])))
            for above, p, n in ((True, p0 - bads[below], n0 - (below - bads[below])), (False, bads[below], below - bads[below])):
                gain = _gain(p, n, p0, n0)
                if len(gain) and gain.max() > best[0]:
                    best = (float(gain.max()), (name, above, float(cuts[int(gain.argmax())])))
        if best[1] is None:
            break
        name, above, cut = best[1]
        v = x[name][inside]  # the cut goes to the middle of the gap between the values that it parts
        rule.append((name, above, float(v[v <= cut].max() + v[v > cut].min()) / 2))
        before, inside = inside.sum(), covers(rule, x, len(bad))
        if inside.sum() in (0, before):  # nothing more is told apart
            rule.pop()
            break
    return rule


def prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The prefix of the rule of the highest smoothed purity less its misses; the shortest of equals."""

    def worth(r: Rule) -> float:
        hit = covers(r, x, len(bad))
        p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
        return (p - n) / (p + n + 1)

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=[])


def learn(x: dict[str, np.ndarray], bad: np.ndarray, turn: np.ndarray) -> list[Rule]:
    """The decision list that rejects; turn % 3 == 0 marks the rows held for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while True:
        g, h = left & (turn % 3 != 0), left & (turn % 3 == 0)
        if not bad[g].any():
            break
        rule = prune(grow({k: v[g] for k, v in x.items()}, bad[g]), {k: v[h] for k, v in x.items()}, bad[h])
        hit = covers(rule, x, len(bad)) & left
        p, n = int(bad[hit & h].sum()), int((~bad[hit & h]).sum())
        if not rule or hit.sum() < MIN_COVER or p < MIN_HELD or (p + 1) / (p + n + 1) < MIN_PURITY or int((~bad[hit & g]).sum()) > 0.05 * hit.sum():
            break
        rules.append(rule)
        left &= ~hit
    return rules


def sampled(labels: DataFrame, label_col: str, bound: int) -> DataFrame:
    """(labelled_id, label) of at most `bound` ids."""
    one = labels.select(F.col("doc_id").alias("labelled_id"), F.col(label_col).cast("int").alias("label")).dropna().groupBy("labelled_id").agg(F.min("label").alias("label"))
    return stage(bounded_sample(one, "labelled_id", bound), "labelled")


def learn_rules(stats: DataFrame, chosen: DataFrame) -> list[Rule]:
    """The rules learnt from the rows of stats that pass the base and whose ids were chosen."""
    passed = stats.select("doc_id", *COUNTS).filter(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    rows = passed.join(chosen, passed.doc_id == chosen.labelled_id)
    rows = rows.groupBy("labelled_id", "label").agg(F.min(F.struct(*COUNTS)).alias("c")).select("c.*", "label", F.xxhash64("labelled_id").alias("turn"))  # at most a row a chosen id
    found = rows.toPandas().sort_values(["turn", *COUNTS, "label"])
    if not len(found):
        return []
    x = {k: np.asarray(v, float) for k, v in ratios(lambda c: found[c].to_numpy(float), np.divide).items()}
    return learn(x, found["label"].to_numpy() == 0, found["turn"].to_numpy() // 7)


def verdict(rules: list[Rule]) -> Column:
    """The decision list as an ordered conditional: false for the first rule that fits, else true."""
    x, out = ratios(F.col, F.try_divide), F.lit(True)
    for rule in reversed(rules):
        hit = F.lit(True)
        for name, above, cut in rule:
            hit &= x[name] > F.lit(cut) if above else x[name] <= F.lit(cut)
        out = F.when(hit, F.lit(False)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = BOUND) -> DataFrame:
    """doc_id, the COUNTS, base_failed and kept of every row."""
    stats = stage(with_statistics(docs, id_col, text_col), "statistics")
    failed, rules = base_failed(F.col("n_words"), F.col("n_repeat_words")), learn_rules(stats, sampled(labels, "quality", bound))
    return stats.withColumn("base_failed", failed).withColumn("kept", F.when(failed, F.lit(False)).otherwise(verdict(rules)))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = BOUND) -> DataFrame:
    """The rows of docs, all columns as they are, that the rules keep; statistics are computed in the same pass."""
    chosen = sampled(labels, "quality", bound)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    labelled = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"), "left_semi")  # the sample is of bounded size
    rules, at = learn_rules(with_statistics(labelled), chosen), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, at):
                table = np.array([statistics(t) for t in batch.column(at).to_pylist()], np.int64).reshape(-1, len(COUNTS))
                counts = dict(zip(COUNTS, table.T.astype(float), strict=True))
                good = (counts["n_words"] >= MIN_WORDS) & (100 * counts["n_repeat_words"] <= MAX_REPEAT_PERCENT * counts["n_words"])
                with np.errstate(divide="ignore", invalid="ignore"):
                    x = ratios(counts.__getitem__, np.divide)
                for rule in rules:
                    good &= ~covers(rule, x, len(good))
                yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
