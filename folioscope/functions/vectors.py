"""Vector arithmetic as native column expressions, in double precision and a fixed order of summation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-12


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(doubles(a), doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(doubles(v), F.lit(0.0), lambda s, x: s + x * x))


def normalised(v: Column) -> Column:
    """``v`` over its norm plus a small constant, so that zero stays zero."""
    length = norm(v) + F.lit(EPSILON)
    return F.transform(doubles(v), lambda x: x / length)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / ((norm(a) + F.lit(EPSILON)) * (norm(b) + F.lit(EPSILON)))


def finite(v: Column) -> Column:
    """Whether no component is null, NaN or infinite."""
    limit = F.lit(float("inf"))
    return F.forall(doubles(v), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))


def ceil_div(n: Column, d: int) -> Column:
    return F.ceil(n / F.lit(d)).cast("long")


def resized(width: Column, height: Column, cap: int) -> Column:
    """struct(width, height, downscaled): the long edge at most ``cap`` (0: no cap), halves to even, at least 1."""
    if cap <= 0:
        return F.struct(width.alias("width"), height.alias("height"), F.lit(False).alias("downscaled"))
    scale = F.lit(float(cap)) / F.greatest(width, height)
    over = F.greatest(width, height) > cap

    def edge(x: Column) -> Column:
        return F.when(over, F.greatest(F.lit(1), F.bround(x * scale).cast("int"))).otherwise(x)

    return F.struct(edge(width).alias("width"), edge(height).alias("height"), over.alias("downscaled"))


def grid(n: Column) -> Column:
    """struct(cols, rows) of a near-square grid of ``n`` tiles."""
    cols = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
    return F.struct(cols.alias("cols"), F.ceil(n / cols).cast("int").alias("rows"))
