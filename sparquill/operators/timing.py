"""Measured latency: the phases of a batch, each written as a table, with the rows that passed and the time that they took."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparquill.staging import stage


class Phases:
    """Runs phases one after another. The rows of a phase are counted by an Observation while they are written, so measuring
    adds no pass; the time is that of the write, all tasks included."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.taken: list[tuple[str, int, float]] = []

    def run(self, name: str, df: DataFrame) -> DataFrame:
        seen, began = Observation(f"phase {len(self.taken)} {name}"), time.perf_counter()
        out = stage(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
        self.taken.append((name, seen.get["n"], 1000 * (time.perf_counter() - began)))
        return out

    def table(self) -> DataFrame:
        """(phase, n_rows, elapsed_ms), in order."""
        return self.spark.createDataFrame(self.taken, "phase string, n_rows long, elapsed_ms double").coalesce(1)

    def latency(self, cases: DataFrame) -> DataFrame:
        """cases with latency_ms: what the phases so far took, shared out among all cases, as a batch answers them together."""
        total = sum(ms for _, _, ms in self.taken)
        each = cases.agg((F.lit(total) / F.greatest(F.count("*"), F.lit(1))).alias("latency_ms"))
        return cases.join(F.broadcast(each))  # one row
