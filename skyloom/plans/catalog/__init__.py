"""Registered queries: every operator bound to the given tables, with its SQL equivalent."""

from skyloom.plans.catalog import (  # noqa: F401
    analysis,
    features,
    grids,
    quality,
    scalars,
    sources,
    streams,
    tables,
)
from skyloom.plans.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
