"""All registered queries."""

from shelfmark.plans import (  # noqa: F401
    catalog_loads,
    catalog_normalize,
    catalog_queues,
    catalog_reports,
    catalog_similarity,
    catalog_sources,
    catalog_standing,
    catalog_star,
    catalog_touches,
)
from shelfmark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
