"""All registered queries."""

from millrace.plans import (  # noqa: F401
    catalog_queries, customer_queries, feature_queries, model_queries, relational_queries, stream_queries,
)
from millrace.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
