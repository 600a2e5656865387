"""Operators for preparing training text at scale, with their queries."""

from . import (  # noqa: F401
    audit, contamination, html, licenses, minhash, ngrams, packing, pii, secrets, topk, toxicity, variants,
    vectors,
)
from .common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
