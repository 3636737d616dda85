"""Every query over the driver's tables with its DuckDB equivalent."""

from campanile.plans import arrays, checks, extraction, relations, reports, states, texts
from campanile.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "arrays", "checks", "extraction", "relations", "reports", "states", "texts"]
