"""Pieces of the DuckDB check queries."""

from __future__ import annotations

from collections.abc import Iterable

from larderspark.plans.fixtures import VIEWS

# Unicode White_Space as an RE2 class and as the characters of a trim.
CLASS = (r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
         r"\x{202F}\x{205F}\x{3000}]")
_CODES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
          0x202F, 0x205F, 0x3000]
SPACES = "concat(" + ", ".join(f"chr({c})" for c in _CODES) + ")"


def collapse(column: str) -> str:
    return f"trim(regexp_replace({column}, '{CLASS}+', ' ', 'g'), ' ')"


def normalize(column: str) -> str:
    return collapse(f"regexp_replace(coalesce(CAST({column} AS VARCHAR), ''), '<[^>]+>', ' ', 'g')")


def with_views(views: Iterable[str], *ctes: str, body: str) -> str:
    """``WITH`` the fixture views and further CTEs, then the body."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in views] + [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
