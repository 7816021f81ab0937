"""Registered queries and their SQL."""

from __future__ import annotations

from . import crawl, discover, ingest, validate  # noqa: F401  (they register their queries)
from .registry import ORACLES, QUERIES


def flagship(spark, sf_dir):
    """Candidates merged by source, ranked, filled up with recent documents."""
    return QUERIES["q05_topk_fallback"](spark, sf_dir)


__all__ = ["ORACLES", "QUERIES", "flagship"]
