"""All registered queries."""

from lakeproof.plans import queries_checks, queries_edges, queries_ingest, queries_keys, queries_profile  # noqa: F401
from lakeproof.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
