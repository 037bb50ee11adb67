"""Registered queries over the given tables."""

from __future__ import annotations

from tickloom.plans import (  # noqa: F401
    book_queries,
    candle_queries,
    file_queries,
    load_queries,
    table_queries,
    text_queries,
    ticker_queries,
)
from tickloom.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracles():
    return dict(ORACLES)
