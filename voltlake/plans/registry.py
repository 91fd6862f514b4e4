"""All registered queries: those of the catalogue, of the lifecycle and of the tables kept up to date."""

from voltlake.plans import lifecycle, maintenance  # noqa: F401  they register their queries
from voltlake.plans.catalogue import QUERIES

__all__ = ["QUERIES"]
