"""All registered queries and their SQL checks."""

from __future__ import annotations

from larderspark.plans import (
    oracles_catalog, oracles_reviews, oracles_search, queries_catalog, queries_reviews, queries_search,
)

QUERIES = {**queries_reviews.QUERIES, **queries_catalog.QUERIES, **queries_search.QUERIES}
ORACLES = {**oracles_reviews.ORACLES, **oracles_catalog.ORACLES, **oracles_search.ORACLES}
FLAGSHIP = "hybrid_search"
