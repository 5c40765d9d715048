"""The operators bound to the driver's tables, each with the SQL that checks it."""

from . import charts, features, models, profile, quality, scores, select, tabulate  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
