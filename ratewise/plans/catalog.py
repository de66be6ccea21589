"""All registered queries (importing this module fills the registry)."""

from . import (  # noqa: F401
    job_queries, language_queries, profile_queries, recommend_queries, service_queries, stream_queries, text_queries)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
