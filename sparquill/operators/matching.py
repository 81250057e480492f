"""Many patterns at once: which keywords of a rules table a text holds, by one automaton and one pass over the text.

The rules are a table, not code: a plan does not grow with them. Tasks write the patterns as files of at most `BLOCK` rows; a worker
builds an Aho-Corasick automaton of each file once and runs it over the texts of its batches. As many automata as
`KEPT` patterns make are kept, further ones are built again for each batch. A pattern is held if the text has it as a substring, as
F.contains says; patterns and texts are taken as they are, so lower them first where case shall not count.

Defined results: a null text holds nothing; a null pattern is no pattern; an empty one is held by every text; a repeated pattern
is one, with all its labels.
"""

from __future__ import annotations

from collections.abc import Callable

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparquill.blocks import read_block, write_blocks

#: Patterns of a file, and those that a worker keeps.
BLOCK, KEPT = 100_000, 400_000
_BUILT: dict[str, tuple[ahocorasick.Automaton, list, int]] = {}


def _automaton(path: str) -> tuple[ahocorasick.Automaton, list, int]:
    """The automaton of a file of (pattern, labels), the labels of its empty pattern, and how many patterns it has."""
    if path not in _BUILT:
        rows = read_block(path)
        built, empty = ahocorasick.Automaton(), []
        for pattern, labels in zip(rows["pattern"].to_pylist(), rows["labels"].to_pylist(), strict=True):
            if pattern:
                built.add_word(pattern, (pattern, labels))
            else:
                empty = [(pattern, labels)]
        if len(built):
            built.make_automaton()
        while _BUILT and sum(n for _, _, n in _BUILT.values()) + rows.num_rows > KEPT:
            del _BUILT[next(iter(_BUILT))]
        _BUILT[path] = built, empty, rows.num_rows
    return _BUILT[path]


def _folded(text: Column, rules: DataFrame, pattern: str, label: Column, fold: Callable[[dict[str, list[str]]], object], kind: str) -> Column:
    """fold({pattern: labels}) of the patterns that each text holds."""
    table = rules.select(F.col(pattern).cast("string").alias("pattern"), label.alias("label")).filter(F.col("pattern").isNotNull())
    paths = write_blocks(table.groupBy("pattern").agg(F.collect_set("label").alias("labels")), BLOCK, name="patterns")

    def run(texts: pd.Series) -> pd.Series:
        held: list[dict[str, list[str]]] = [{} for _ in range(len(texts))]
        for path in paths:
            built, empty, _ = _automaton(path)
            for found, said in zip(held, texts.tolist(), strict=True):
                if said is not None:
                    found.update(empty)
                    if len(built):
                        found.update(x for _, x in built.iter(said))
        return pd.Series([fold(x) for x in held])

    return F.pandas_udf(run, kind)(text)


def held(text: Column, rules: DataFrame, pattern: str = "keyword") -> Column:
    """The patterns that a text holds, sorted, each once."""
    return _folded(text, rules, pattern, F.lit(""), lambda x: sorted(x), "array<string>")


def labels(text: Column, rules: DataFrame, pattern: str = "keyword", label: str = "tag") -> Column:
    """The labels of all patterns that a text holds, sorted, each once."""
    return _folded(text, rules, pattern, F.col(label).cast("string"), lambda x: sorted({t for ts in x.values() for t in ts}), "array<string>")


def counts(text: Column, rules: DataFrame, pattern: str = "keyword", label: str = "src") -> Column:
    """How many patterns of each label a text holds; labels without any are not there."""

    def fold(x: dict[str, list[str]]) -> dict[str, int]:
        out: dict[str, int] = {}
        for ts in x.values():
            for t in ts:
                out[t] = out.get(t, 0) + 1
        return out

    return _folded(text, rules, pattern, F.col(label).cast("string"), fold, "map<string,int>")
