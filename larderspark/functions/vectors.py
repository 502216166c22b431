"""Vector expressions on array columns, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larderspark.functions.binding import let


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    squares = F.aggregate(
        a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def same_dimension(a: Column, b: Column) -> Column:
    """``a``, or an error when both are present and differ in length."""
    differ = F.size(a) != F.size(b)
    return F.when(
        differ, F.raise_error(F.lit("vectors of different dimensions")).cast("array<double>")
    ).otherwise(a.cast("array<double>"))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine, null where a vector is missing, empty or of zero length.

    Vectors of different dimensions raise instead of being cut to the shorter.
    """
    usable = (F.size(a) > 0) & (F.size(b) > 0)
    length = (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b)
    return F.when(usable, let(
        length, lambda n: F.when(n != 0, dot(same_dimension(a, b), b) / n)))


def scale(a: Column, length: Column) -> Column:
    """``a`` divided by ``length`` as floats; a zero vector stays as it is."""
    return let(length, lambda n: F.when(
        n > 0, F.transform(a, lambda x: (x / n).cast("float"))
    ).otherwise(a.cast("array<float>")))
