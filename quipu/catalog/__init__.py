"""Every query by name, with the SQL that must give the same rows."""

from . import changes, grouping, joining, loads, models, reporting, shaping  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
