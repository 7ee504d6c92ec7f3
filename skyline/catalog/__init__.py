"""Registered queries and their SQL, in one place."""

from __future__ import annotations


def load():
    """Import every query module; returns (queries, oracles)."""
    from skyline.catalog import feature_queries, feed_queries, report_queries  # noqa: F401
    from skyline.catalog.registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
