"""All registered queries; importing this module fills the registry."""

from logharbor.plans import (  # noqa: F401
    detection_queries,
    feature_queries,
    ingest_queries,
    metric_queries,
    protection_queries,
    stream_queries,
)
from logharbor.plans.registry import QUERIES

__all__ = ["QUERIES"]
