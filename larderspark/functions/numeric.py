"""Numeric expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column) -> Column:
    """Unparsable text becomes null."""
    return c.try_cast("double")


def to_long(c: Column) -> Column:
    """Unparsable becomes null; ``12.0`` and ``1.5`` truncate.

    Whole-number text is parsed exactly; only the rest goes through double.
    """
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def numeric_text(c: Column) -> Column:
    """Double from decimal text only: no ``nan``, ``inf`` or type suffixes."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive, else null."""
    return F.when(
        denominator > 0, numerator.cast("double") / denominator.cast("double")
    )


def exact_ratio(numerator: Column, denominator: Column) -> Column:
    """``ratio`` of whole numbers as a decimal of 24 places.

    Decimals add up to the same sum in any order of rows, so a mean that lies
    between two rounded values does not go up in one run and down in the next.
    """
    parts = numerator.cast("decimal(28,18)") / denominator.cast("decimal(10,0)")
    return F.when(denominator > 0, parts.cast("decimal(34,24)"))


def round_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def plain_number(c: Column) -> Column:
    """Number as text without exponent or a trailing ``.0``."""
    whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
    fixed = F.regexp_replace(c.try_cast("decimal(38,17)").cast("string"), r"0+$", "")
    return F.when(whole, c.try_cast("bigint").cast("string")).otherwise(
        F.coalesce(fixed, c.cast("string"))
    )


def bounded_cosine(similarity: Column) -> Column:
    return F.when(
        similarity.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), similarity))
    )


def angle_degrees(similarity: Column) -> Column:
    return round_even(F.degrees(F.acos(bounded_cosine(similarity))), 2)


def angle_relevance(similarity: Column) -> Column:
    """100 for the same direction, 0 at a right angle or beyond."""
    share = F.lit(1.0) - F.acos(bounded_cosine(similarity)) / F.lit(math.pi / 2)
    percent = round_even(share * 100, 0).cast("int")
    return F.when(
        similarity.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(100), percent))
    )


def score_relevance(score: Column, reference: Column) -> Column:
    """Score as a share of the reference, 8..99; 0 when neither is positive."""
    base = F.when(reference > 0, reference).otherwise(score)
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), score / base))
    percent = round_even(share * 100, 0).cast("int")
    return F.when(base > 0, F.greatest(F.lit(8), F.least(F.lit(99), percent))).otherwise(
        F.lit(0)
    )
