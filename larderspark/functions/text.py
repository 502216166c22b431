"""Text expressions. Whitespace always means the Unicode White_Space property."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from larderspark.functions.binding import let

# Unicode White_Space, for trims (no regex needed).
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_RUNS = r"(?U)\s+"
_TAGS = r"<[^>]+>"


def strip(c: Column) -> Column:
    """Trim Unicode whitespace on both ends; inner whitespace is kept."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse(c: Column) -> Column:
    """Each whitespace run becomes one space; ends are trimmed."""
    return F.btrim(F.regexp_replace(c, _RUNS, " "), F.lit(" "))


def normalize_text(c: Column) -> Column:
    """Null to blank, HTML tags to spaces, whitespace collapsed, trimmed."""
    value = F.coalesce(c.cast("string"), F.lit(""))
    # most texts have no tag at all and skip that pass
    return collapse(F.when(value.contains("<"), F.regexp_replace(value, _TAGS, " ")).otherwise(value))


def clean_text(c: Column) -> Column:
    """Whitespace collapsed and trimmed; null stays null."""
    return collapse(c.cast("string"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# Words that stand for "no value" in catalogue fields.
JUNK_WORDS = ("unknown", "n/a", "-")


def clean_field(c: Column) -> Column:
    """Drop two-letter language prefixes, unify separators, blank the junk words."""
    value = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"(?U)\b[a-z]{2}:", "")
    value = F.translate(value, ";", ",")
    value = F.regexp_replace(value, r"(?U),\s*,", ",")
    value = F.btrim(F.regexp_replace(value, _RUNS, " "), F.lit(" ,"))
    return F.when(F.lower(value).isin(*JUNK_WORDS), F.lit("")).otherwise(value)


def clean_product_name(c: Column) -> Column:
    return collapse(F.translate(F.coalesce(c, F.lit("")), ";", " "))


def initcap_words(c: Column) -> Column:
    """Capitalise the first letter after every non-alphanumeric character."""
    runs = F.regexp_extract_all(
        F.lower(c), F.lit(r"(?U)(\p{Alnum}+|[^\p{Alnum}]+)"), F.lit(1)
    )
    capped = F.transform(
        runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), r.substr(F.lit(2), F.length(r)))
    )
    return F.array_join(capped, "")


def truncate(c: Column, max_chars: int) -> Column:
    """First ``max_chars`` characters with null as blank; 0 keeps everything."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.substring(text, 1, max_chars) if max_chars > 0 else text


def clip_text(c: Column, limit: int = 180) -> Column:
    """Shorten at a word boundary and mark the cut with three dots."""
    text = F.btrim(F.regexp_replace(c, _RUNS, " "), F.lit(" .|"))
    cut = F.regexp_replace(F.substring(text, 1, limit), r" [^ ]*\z", "")
    return F.when(F.char_length(text) <= limit, text).otherwise(
        F.concat(F.btrim(cut, F.lit(" ,;:-")), F.lit("..."))
    )


def text_list(c: Column) -> Column:
    """Trimmed, non-blank members of an array; null becomes an empty array."""
    items = F.coalesce(c, F.array().cast("array<string>"))
    return F.filter(F.transform(items, strip), lambda x: x != "")


def distinct_texts(c: Column) -> Column:
    """Keep the first of texts equal up to case and whitespace (short arrays)."""
    keys = F.transform(c, lambda x: F.lower(collapse(x)))
    return let(keys, lambda ks: F.filter(
        c,
        lambda x, i: (F.get(ks, i) != "") & (F.array_position(ks, F.get(ks, i)) == (i + 1)),
    ))


def contains_any(c: Column, words: Sequence[str]) -> Column:
    found = c.contains(words[0])
    for word in words[1:]:
        found = found | c.contains(word)
    return found


def slug(c: Column) -> Column:
    """Lower case with every other run as one underscore (artefact names)."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def suffix(c: Column) -> Column:
    """The second naming rule: only ``:``, ``-`` and ``.`` become underscores."""
    return F.translate(c, ":-.", "___")


def literal_count(text: Column, needle: Column) -> Column:
    """Non-overlapping literal occurrences of ``needle``; 0 for a blank one."""
    removed = F.char_length(text) - F.char_length(F.replace(text, needle, F.lit("")))
    return F.when(
        F.char_length(needle) > 0, F.floor(removed / F.char_length(needle)).cast("int")
    ).otherwise(F.lit(0))
