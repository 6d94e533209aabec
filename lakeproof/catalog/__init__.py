"""Registered queries: one per operator, over the driver's tables, with their SQL."""

from lakeproof.catalog import (  # noqa: F401
    aggregates, comparisons, filters, incremental, loads, projections, readers,
)
from lakeproof.catalog.registry import ORACLES, QUERIES  # noqa: F401
