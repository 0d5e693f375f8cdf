"""Registered queries, one module per operator family, each with the SQL it is checked against."""

from tallyspan.plans import (  # noqa: F401  (import registers the queries)
    aggregates,
    alerts,
    catalog,
    expressions,
    flagship,
    ingest,
    orderings,
    postaggs,
    rollups,
    selects,
    spatial,
    streams,
    time,
    transfers,
    transforms,
)
from tallyspan.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
