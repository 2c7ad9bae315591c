"""All registered queries with their SQL oracles."""

from . import (aggregates, checks, geometry, increments, joins, projections,  # noqa: F401
               rasters, scalars, sinks, sources, studies)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
