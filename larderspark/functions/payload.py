"""JSON found in text, JSON-safe payload columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strict_json(c: Column) -> Column:
    """The text as one JSON value (a variant), null for anything else.

    ``try_parse_json`` stops after the first value and ignores what follows, so
    the text is parsed as the only member of an array and of an object:
    trailing text breaks at least one of them.
    """
    member = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    field = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    alone = field.isNotNull() & F.try_variant_get(member, "$[1]", "variant").isNull()
    return F.when(alone, F.try_variant_get(member, "$[0]", "variant"))


def extract_json(c: Column) -> Column:
    """The text as JSON, else its widest ``{...}`` part, else null (a variant)."""
    widest = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.coalesce(strict_json(c), strict_json(F.nullif(widest, F.lit(""))))


_KEPT = (T.StringType, T.NumericType, T.BooleanType)


def _safe(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _safe(x, kind.elementType))
    if isinstance(kind, _KEPT):
        return c
    return c.cast("string")


def payload_json(df: DataFrame, exclude: Iterable[str] = (), **extra: Column) -> Column:
    """All other columns as one JSON object; types JSON lacks become text."""
    skipped = set(exclude)
    fields = [
        _safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
        for f in df.schema if f.name not in skipped and f.name not in extra
    ]
    fields += [c.alias(name) for name, c in extra.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
