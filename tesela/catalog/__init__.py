"""Named queries on the driver tables, each with the SQL that states its meaning."""

from . import anomalies, models, operators, plans, scalars, sources  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
