"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product of two numeric arrays in double precision, summed in array order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(a: Column) -> Column:
    """The array scaled to length one; a zero vector stays."""
    norm = F.sqrt(dot(a, a))
    return F.when(norm > 0, F.transform(a, lambda x: x / norm)).otherwise(F.transform(a, lambda x: x.cast("double")))
