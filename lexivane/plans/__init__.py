"""All registered queries."""

from . import (  # noqa: F401
    q_coverage,
    q_delivery,
    q_functions,
    q_sources,
    q_streaming,
    q_topics,
    q_vectors,
)
from .common import ORACLE, QUERIES
from .flagship import flagship

__all__ = ["ORACLE", "QUERIES", "flagship"]
