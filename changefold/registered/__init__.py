"""The checked queries: each reads the given tables whole and has, where SQL can say it, an oracle."""

from . import book, cdc, loanbook, quality, serving, streams
from .book import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "book", "cdc", "loanbook", "quality", "serving", "streams"]
