"""Vectors as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Summed in doubles, in order."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a: Column) -> Column:
    """Of length 1; a vector of zeros stays."""
    # As a lambda's variable the length is made once, not for each component.
    by = lambda length: F.transform(a, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(x.cast("double")))
    return F.transform(F.array(norm(a)), by)[0]


def quantize(a: Column, levels: int = 127) -> Column:
    """Components times ``levels`` in single precision, halves to even, as bytes."""
    scaled = lambda x: F.rint((x.cast("float") * F.lit(float(levels)).cast("float")).cast("double"))
    return F.transform(a, lambda x: F.greatest(F.lit(-float(levels)), F.least(F.lit(float(levels)), scaled(x))).cast("tinyint"))
