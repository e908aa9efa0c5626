"""Vector column expressions; sums are in double."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearlake.functions import formats


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )


def cosine(a: Column, b: Column) -> Column:
    """0 if either has no length."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def literal(v: Column) -> Column:
    """``[x,...]`` with 8 decimals; components below 90 million."""
    return F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: formats.fixed(x, 8)), ","), F.lit("]"))
