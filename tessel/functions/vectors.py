"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normalize(v: Column, least: float = 1e-12) -> Column:
    norm = F.greatest(F.sqrt(dot(v, v)), F.lit(least))
    return F.transform(v, lambda x: x.cast("double") / norm)


def rounded(x: Column, digits: int) -> Column:
    """A double as SQL rounds it: the product with the power of ten, halves away from zero; negative values keep their sign, down to -0.0."""
    scale = F.lit(10.0**digits)
    scaled = F.abs(x * scale)
    return F.when(scaled < float("inf"), F.signum(x) * F.round(scaled) / scale).otherwise(x)


def position_of(ids: Column, wanted: Column) -> Column:
    """From 0; -1 if absent."""
    return F.array_position(ids, wanted).cast("int") - 1


def value_at(values: Column, position: Column, missing: float = 0.0) -> Column:
    return F.when(position >= 0, F.get(values, position)).otherwise(F.lit(missing))
